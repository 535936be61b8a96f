"""Rule classification, skip reasons, document types and triage, from configuration tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawork.functions.columns import extension, file_name
from stratawork.operators.mail import let

#: Synthetic defaults: family, extensions, skipped.
FAMILIES = [
    ("document", [".pdf", ".doc", ".docx", ".txt", ".rtf"], False),
    ("spreadsheet", [".xls", ".xlsx", ".csv"], False),
    ("image", [".jpg", ".png", ".tif"], False),
    ("email", [".eml", ".msg"], False),
    ("archive", [".zip", ".7z"], False),
    ("executable", [".exe", ".dll"], True),
]
SYSTEM_EXTENSIONS = [".tmp", ".sys", ".lnk"]
#: (document type, subtype, confidence, groups of words: one of each group is in the text), in order; fixed values.
DOC_TYPES = [
    ("Invoice", "", "medium", [["invoice"]]),
    ("LTC_Claim", "", "medium", [["claim"], ["long-term care", "ltc"]]),
    ("LTC_Claim", "", "low", [["benefit", "coverage"], ["claim"]]),
    ("Trust_Document", "Amendment", "medium", [["amendment", "restatement"]]),
    ("Trust_Document", "", "medium", [["trust"], ["trustee", "beneficiary", "fiduciary"]]),
    ("Trust_Document", "", "low", [["trust"]]),
    ("Insurance_Policy", "", "low", [["premium"]]),
    ("Insurance_Policy", "", "low", [["policy"], ["long-term care"]]),
]
#: What a family of files says of text and of recognition (pdf depends on its sample); fixed values.
TEXT_FAMILIES = ["text_file", "word_doc", "spreadsheet", "presentation", "email_file"]
SILENT_FAMILIES = ["image", "audio", "video"]
READABLE_FAMILIES = [*TEXT_FAMILIES, "audio", "video", "archive"]
WEIGHTS = {("DocType", "Invoice"): 30, ("DocType", "LTC_Claim"): 25, ("DocType", "Trust_Document"): 25, ("Confidence", "medium"): 10, ("Money", "Y"): 20, ("Date", "Y"): 10, ("Keyword", "Y"): 15, ("Entity", "Y"): 20, ("OCR", "Y"): 5}
BANDS = [("High", 60), ("Medium", 35), ("Low", 10), ("Skip", 0)]
NEXT_STEPS = {"High": "Review now", "Medium": "Review", "Low": "Sample", "Skip": "Archive"}


def family(path: Column, families=FAMILIES) -> Column:
    """The first family, in order, that lists the extension, else other."""
    ext, case = extension(path), None
    for name, extensions, _ in families:
        case = F.when(ext.isin(extensions), name) if case is None else case.when(ext.isin(extensions), name)
    return case.otherwise("other") if case is not None else F.lit("other")


def skip_reason(path: Column, families=FAMILIES) -> Column:
    """Why a file is skipped: its family, a lock file, a hidden file, a system extension, in this order; empty if it is not."""
    name = file_name(path)
    skipped = [f for f, _, skip in families if skip]
    return F.when(family(path, families).isin(skipped), F.concat(F.lit("family:"), family(path, families))).when(name.startswith("~$"), "lock_file").when(name.startswith("."), "hidden").when(extension(path).isin(SYSTEM_EXTENSIONS), "system").otherwise("")


def family_join(df: DataFrame, path: str, families: DataFrame, rows: int = 10_000) -> DataFrame:
    """``df`` with family and should_skip from a loaded table (``config.families``: an extension a row); other and N where none lists it.

    The table is broadcast if it is counted to be small, else shuffled.
    """
    table = families.select(F.col("extension").alias("__e"), "family", "should_skip")
    table = F.broadcast(table) if families.limit(rows + 1).count() <= rows else table
    j = df.withColumn("__x", extension(F.col(path))).join(table, F.col("__x") == F.col("__e"), "left").drop("__x", "__e")
    return j.withColumn("family", F.coalesce("family", F.lit("other"))).withColumn("should_skip", F.coalesce("should_skip", F.lit("N")))


def active_keywords(df: DataFrame, keyword: str = "keyword", active: str = "active") -> DataFrame:
    """The keywords that are not empty and marked Y, case and spaces aside."""
    return df.filter((F.coalesce(F.col(keyword), F.lit("")) != "") & (F.upper(F.trim(F.coalesce(F.col(active), F.lit("")))) == "Y")).select(keyword)


def in_system_folder(path: Column, folders: list[str]) -> Column:
    """Whether any part of a path is a system folder, case aside."""
    return F.arrays_overlap(F.split(F.lower(F.translate(path, "\\", "/")), "/"), F.array(*(F.lit(f.lower()) for f in folders)))


def doc_type(text: Column, hits: Column | None = None, rules=DOC_TYPES) -> Column:
    """struct<doc_type, subtype, confidence> of the first rule that a text and its keyword hits meet; empty if none."""
    low = F.concat_ws(" ", F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(hits, F.lit(""))) if hits is not None else F.lit(""))
    named = lambda kind, sub, confidence: F.struct(F.lit(kind).alias("doc_type"), F.lit(sub).alias("subtype"), F.lit(confidence).alias("confidence"))

    def first(said: Column) -> Column:
        found = []
        for kind, sub, confidence, groups in rules:
            hit = F.lit(True)
            for words in groups:
                some = F.lit(False)
                for w in words:
                    some = some | said.contains(w)
                hit = hit & some
            found.append(F.when(hit, named(kind, sub, confidence)))
        return F.coalesce(*found, named("", "", ""))

    return let(low, first)  # lower case once, not in each test


def likely_text(family_: Column, sample: Column, extracted: Column) -> Column:
    """Whether a file is likely to hold text: Y, N, or empty where its family says nothing; a pdf by its sample."""
    fam, read = F.lower(F.coalesce(family_, F.lit(""))), F.coalesce(extracted, F.lit(False)) & (F.coalesce(sample, F.lit("")) != "")
    return F.when(fam.isin(TEXT_FAMILIES) | ((fam == "pdf") & read), "Y").when(fam.isin(SILENT_FAMILIES) | (fam == "pdf"), "N").otherwise("")


def needs_recognition(family_: Column, sample: Column, extracted: Column, density: Column | None = None) -> Column:
    """Whether a file needs character recognition; for a pdf, a verdict by pages (``page_density``) comes first where there is one."""
    fam, read = F.lower(F.coalesce(family_, F.lit(""))), F.coalesce(extracted, F.lit(False)) & (F.coalesce(sample, F.lit("")) != "")
    by_family = F.when(fam.isin(READABLE_FAMILIES) | ((fam == "pdf") & read), "N").when(fam.isin("pdf", "image"), "Y").otherwise("")
    return by_family if density is None else F.when((fam == "pdf") & (F.coalesce(density, F.lit("")) != ""), density).otherwise(by_family)


def score_join(df: DataFrame, key: str, signals: dict[str, Column], weights: DataFrame) -> DataFrame:
    """(key, score) from a loaded table of weights (``config.weights``): signals as rows, an equi join, a sum kept within 0 and 100."""
    each = df.select(key, F.explode(F.array(*(F.struct(F.lit(s).alias("signal_type"), v.cast("string").alias("signal_value")) for s, v in signals.items()))).alias("x")).select(key, "x.*")
    points = each.join(weights, ["signal_type", "signal_value"], "left").groupBy(key).agg(F.sum(F.coalesce("points", F.lit(0))).alias("score"))
    return points.withColumn("score", F.greatest(F.lit(0), F.least(F.lit(100), F.col("score"))))


def band_join(df: DataFrame, key: str, score: str, bands: DataFrame, default: str = "Skip") -> DataFrame:
    """(key, score, band) from a loaded table of bands (band, min_score), in order of its least scores; it is sorted into one small row."""
    row = bands.agg(F.sort_array(F.collect_list(F.struct("min_score", "band")), asc=False).alias("__b"))  # a configuration of few bands
    hit = F.get(F.filter("__b", lambda b: b["min_score"] <= F.col(score)), F.lit(0))["band"]
    return df.crossJoin(F.broadcast(row)).select(key, score, F.coalesce(hit, F.lit(default)).alias("band"))


def weight(signal: str, value: Column, weights=WEIGHTS) -> Column:
    case = F.lit(0)
    for (s, v), points in weights.items():
        if s == signal:
            case = F.when(value == v, points).otherwise(case)
    return case


def triage_score(signals: dict[str, Column], weights=WEIGHTS) -> Column:
    """Sum of the signals' weights, kept within 0 and 100."""
    total = F.lit(0)
    for s, v in signals.items():
        total = total + weight(s, v, weights)
    return F.greatest(F.lit(0), F.least(F.lit(100), total))


def reasons(signals: dict[str, Column], weights=WEIGHTS, left_out: tuple[str, ...] = ("Confidence", "Entity")) -> Column:
    """The signals that added to the score, in order, joined with ';'."""
    parts = [F.when(weight(s, v, weights) > 0, F.concat(F.lit(s + "="), v)) for s, v in signals.items() if s not in left_out]
    return F.concat_ws(";", *parts)


def next_step(band: Column, ocr: Column, steps=NEXT_STEPS) -> Column:
    case = F.when((band == "Medium") & (ocr == "Y"), "OCR then review")
    for b, s in steps.items():
        case = case.when(band == b, s)
    return case.otherwise("Archive")


def page_density(df: DataFrame, key: str, length: str, least: int = 50) -> DataFrame:
    """needs_ocr by pages: N if all have ``least`` characters, Y if none, else PARTIAL."""
    dense = F.col(length) >= least
    return df.groupBy(key).agg(F.when(F.every(dense), "N").when(F.some(dense), "PARTIAL").otherwise("Y").alias("needs_ocr"))


#: Words that leave out what follows them, words and marks that end it, and letters that a word has to have to name a path; fixed values.
LEAVING_OUT, ENDS, NAMING = {"except", "exclude", "excluding", "ignore", "skip"}, {",", "and"}, 4


def scan_request(text: str, known_paths: list[str] = ()) -> dict:
    """What a request in words asks for: depth, kind of scan, exclusions, and which known paths it names.

    A number before "levels deep" is the depth; "file" in any word makes it a
    scan of files; what follows the first word that leaves out is left out, to
    the next end; a known path is meant if it holds a word of NAMING letters or more.
    """
    low = text.lower()
    tokens = [(m[0], *m.span()) for m in re.finditer(r"\w+|,", low)]
    said = [t for t, _, _ in tokens]
    deep = [int(n) for n, what, how in zip(said, said[1:], said[2:]) if n.isdigit() and what in ("level", "levels") and how == "deep"]
    out: dict = {"depth": deep[0] if deep else None, "scan_type": "files" if any("file" in t for t in said) else "dirs", "exclude": []}
    opens = next((k for k, t in enumerate(said) if t in LEAVING_OUT), None)
    if opens is not None:
        stop = next((tokens[k][1] for k in range(opens + 1, len(said)) if said[k] in ENDS), len(low))
        out["exclude"] = [x for x in [low[tokens[opens][2] : stop].strip()] if x]
    names = [t for t in said if len(t) >= NAMING]
    return out | {"paths": [p for p in known_paths if any(w in p.lower() for w in names)]}


def requested(df: DataFrame, path: str, request: dict) -> DataFrame:
    """The rows of an inventory that a request asks for: below one of its paths, not deeper than it says, without what it excludes; without paths, the depth is that of the whole path."""
    from stratawork.functions.columns import norm_path, path_depth

    p = norm_path(F.col(path))
    hit = F.lit(not request["paths"]) & (F.lit(True) if request["depth"] is None else path_depth(F.col(path)) <= request["depth"])
    for base in request["paths"]:
        root = norm_path(F.lit(base))
        near = F.lit(True) if request["depth"] is None else path_depth(p) - path_depth(root) <= request["depth"]
        hit = hit | (((p == root) | p.startswith(F.concat(root, F.lit("/")))) & near)
    for word in request["exclude"]:
        hit = hit & ~p.contains(word)
    return df.filter(hit)
