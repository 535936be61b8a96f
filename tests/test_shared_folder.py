from __future__ import annotations

from types import SimpleNamespace

import pytest

from stratawork.session import shared_folder


@pytest.mark.parametrize("given", ["{}/shared", "{}/shared/", "file:{}/shared", "file://{}/shared/"])
def test_a_folder_without_a_scheme_gets_one(spark, tmp_path, given):
    """It is of the default file system, like the tables that Spark writes beside the files."""
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: given.format(tmp_path)), sparkContext=spark.sparkContext)
    assert shared_folder(session).replace("///", "/") == f"file:{tmp_path}/shared"
