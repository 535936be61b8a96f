"""Scalar column helpers: naming, coercion, paths, sizes, message ids, dates and markers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

RESERVED = {"from": "from_addr", "to": "to_addr"}


def text(c: Column) -> Column:
    """Null as the empty string."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """White space off both ends, line breaks and tabs included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


#: Characters of a header that part its words, and those that go; fixed values.
PARTING, DROPPED = ".-()=_", "?!@#+'\"&"
_HEADER = str.maketrans(PARTING, " " * len(PARTING), DROPPED)


def snake_case(c: Column) -> Column:
    """Header to column name: its words in lower case with one underscore between them."""
    words = F.split(F.translate(F.lower(c), PARTING + DROPPED, " " * len(PARTING)), r"\s+")
    return F.array_join(F.filter(words, lambda w: w != ""), "_")


def snake_name(header: str | None) -> str:
    """``snake_case`` for the driver's side."""
    return "_".join((header or "").lower().translate(_HEADER).split())


def map_headers(headers: list[str | None], suffixes: bool = True) -> list[str]:
    """Column names for headers: empty is ``unnamed``, repeats get _2, _3, then reserved words are renamed.

    Raises if a suffixed name meets another column's.
    """
    seen: dict[str, int] = {}
    out = []
    for h in headers:
        name = snake_name(h) or "unnamed"
        seen[name] = seen.get(name, 0) + 1
        if suffixes and seen[name] > 1:
            name = f"{name}_{seen[name]}"
        out.append(RESERVED.get(name, name))
    if suffixes and len(set(out)) < len(out):
        raise ValueError(f"headers collide: {sorted({x for x in out if out.count(x) > 1})}")
    return out


def camel_to_snake(name: str) -> str:
    return re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name).lower()


def to_long(c: Column) -> Column:
    """INTEGER coercion: blank and unparsable are null, fractions are cut."""
    return _cut(strip(c).try_cast("double"))


def _cut(d: Column) -> Column:
    return F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < 9.2e18), F.when(d < 0, F.ceil(d)).otherwise(F.floor(d)).cast("bigint"))


def currency(c: Column) -> Column:
    return strip(F.regexp_replace(c, "[$,]", "")).try_cast("double")


def extension(path: Column, dot: bool = True) -> Column:
    """Lower-case extension of a file name; a leading dot alone makes none."""
    e = F.lower(F.regexp_extract(path, r"[^/\\]\.([^./\\]+)$", 1))
    return F.when(e != "", F.concat(F.lit("." if dot else ""), e)).otherwise("" if dot else "(none)")


def file_name(path: Column) -> Column:
    return F.substring_index(F.translate(path, "\\", "/"), "/", -1)


def norm_path(path: Column) -> Column:
    """Forward slashes, no slash at the end, lower case."""
    return F.lower(F.regexp_replace(F.translate(path, "\\", "/"), "/+$", ""))


def path_depth(path: Column) -> Column:
    return F.size(F.split(path, "/")) - 1


def path_parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def ancestors(path: Column) -> Column:
    """All prefixes of a path, itself last."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def human_size(n: Column) -> Column:
    """B to PB in steps of 1024 with one decimal; null is N/A."""
    out = F.lit("N/A")
    units = ["B", "KB", "MB", "GB", "TB", "PB"]
    case = F.when(n.isNull(), out)
    for k, u in enumerate(units):
        v = F.format_string("%.1f " + u, n.cast("double") / F.lit(float(1024**k)))
        case = case.otherwise(v) if k == len(units) - 1 else case.when(n < 1024 ** (k + 1), v)
    return case


def message_id(c: Column) -> Column:
    """Merge form: trimmed, lower case, one leading < and one trailing > off."""
    return F.regexp_replace(F.lower(strip(c)), "^<|>$", "")


def message_id_filter(c: Column) -> Column:
    """Filter form: a ``message-id:`` label goes, brackets go as a pair and are put back; null and blank are empty."""
    s = F.lower(strip(text(c)))
    s = strip(F.regexp_replace(s, "^message-id:", ""))
    s = F.when(s.startswith("<") & s.endswith(">") & (F.length(s) >= 2), strip(F.substr(s, F.lit(2), F.length(s) - 2))).otherwise(s)
    return F.when(s == "", "").otherwise(F.concat(F.lit("<"), s, F.lit(">")))


def header_message_id(c: Column) -> Column:
    """The value of a Message-ID header in raw text, folded lines included."""
    return message_id_filter(F.regexp_extract(c, r"(?im)^message-id:[ \t]*(?:\r?\n[ \t]+)?(\S+)", 1))


def safe_text(c: Column, cap: int = 32_000) -> Column:
    """Capped first, then control characters but line breaks and tabs dropped; null is empty."""
    return F.regexp_replace(F.substr(text(c), F.lit(1), F.lit(cap)), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def safe_file_name(c: Column, to: str = "_") -> Column:
    return F.regexp_replace(c, r'[<>:"/\\|?*]', to)


def shorten(c: Column, n: int = 500, suffix: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substr(c, F.lit(1), F.lit(n)), F.lit(suffix))).otherwise(c)


def tri_state(hit: Column, c: Column) -> Column:
    """Y or N, empty where there is no text."""
    return F.when(strip(text(c)) == "", "").when(hit, "Y").otherwise("N")


#: Patterns of amounts and of dates; fixed values.
MONEY = r"\$\s*[\d,]+(?:\.\d{1,2})?|(?i:\b(?:usd|dollars?|cents?)\b)"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
DATES = rf"\b\d{{1,2}}/\d{{1,2}}/\d{{2,4}}\b|\b\d{{4}}-\d{{2}}-\d{{2}}\b|(?i:\b(?:{MONTHS})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}\b)"


def money(c: Column) -> Column:
    return tri_state(c.rlike(MONEY), c)


def dates(c: Column) -> Column:
    return tri_state(c.rlike(DATES), c)


def keyword_list(c: Column) -> Column:
    """Comma-separated keywords, trimmed of quotes and spaces, empties dropped."""
    return F.filter(F.transform(F.split(text(c), ","), lambda x: F.regexp_replace(x, r"^[\s\"']+|[\s\"']+$", "")), lambda x: x != "")


def clock_seconds(c: Column) -> Column:
    """MM:SS or HH:MM:SS to seconds; anything else is null."""
    p = F.split(c, ":")
    n = lambda i: F.get(p, F.lit(i)).try_cast("int")
    return F.when(F.size(p) == 2, n(0) * 60 + n(1)).when(F.size(p) == 3, n(0) * 3600 + n(1) * 60 + n(2))


def srt_time(ms: Column) -> Column:
    ms = ms.cast("bigint")
    part = lambda d, m: F.floor(ms / d) % m
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), part(60_000, 60), part(1000, 60), ms % 1000)


def elapsed(seconds: Column) -> Column:
    s = seconds.cast("bigint")
    return F.format_string("%d:%02d", F.floor(s / 60), s % 60)


def run_id(prefix: str, at: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), F.date_format(at, "yyyyMMdd_HHmmss"))


def forum_date(c: Column, as_of: Column) -> Column:
    """'Today at h:m:s AM' or 'Yesterday ...' against ``as_of``, whose own time stands where none is given, or a full date; anything else is null."""
    raw, now = strip(c), as_of.cast("timestamp")
    base = F.when(F.lower(raw).startswith("today"), now).when(F.lower(raw).startswith("yesterday"), now - F.expr("interval 1 day"))
    clock = F.upper(F.regexp_extract(raw, r"(?i)(\d+:\d+:\d+\s+[AP]M)", 1))
    at = F.try_to_timestamp(F.concat_ws(" ", F.date_format(base, "yyyy-MM-dd"), F.regexp_replace(clock, r"\s+", " ")), F.lit("yyyy-MM-dd h:m:s a"))
    full = F.regexp_extract(raw, r"(?i)^([A-Za-z]+\s+\d+,\s+\d{4},\s+\d+:\d+:\d+\s+)[AP]M", 1)
    half = F.upper(F.regexp_extract(raw, r"(?i)([AP]M)", 1))
    exact = F.try_to_timestamp(F.concat(F.regexp_replace(full, r"\s+", " "), half), F.lit("MMMM d, yyyy, h:m:s a"))
    return F.when(base.isNotNull(), F.when(clock == "", base).otherwise(at)).otherwise(exact)


def forum_date_text(c: Column) -> Column:
    """The first date of a post's header: each part between 'Last Edit:' marks is tried in turn; empty if none has one."""
    date = r"(?i)((?:Today|Yesterday|\w+ \d+, \d{4}),?\s+(?:at\s+)?\d+:\d+:\d+\s+[AP]M)"
    parts = F.transform(F.split(F.regexp_replace(text(c), r"\s+", " "), r"Last Edit\s*:"), lambda p: F.regexp_extract(p, date, 1))
    return text(F.get(F.filter(parts, lambda p: p != ""), F.lit(0)))


def any_date(c: Column) -> Column:
    """The first of the usual formats that fits; two digits of a year from 69 on are of the last century."""
    raw = strip(c)
    day = lambda f: F.to_date(F.try_to_timestamp(raw, F.lit(f)))
    short = day("M/d/yy")
    return F.coalesce(day("M/d/yyyy"), F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short), day("yyyy-MM-dd"), day("MMMM d, yyyy"))


def likes(c: Column) -> Column:
    """N of 'N people like this' or '1 person likes this', else 0."""
    return F.coalesce(F.regexp_extract(text(c), r"(?i)(\d+)\s+(?:people|person)\s+likes?\s+this", 1).try_cast("int"), F.lit(0))


def plain_title(c: Column) -> Column:
    """A title without the marks of replies before it."""
    return F.regexp_replace(c, r"^(?:Re:\s*+)++", "")


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double precision, 0 where a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def tokens(c: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text(c)), r"[^\p{L}\p{N}]+"), lambda x: x != "")


#: Marks of folders that a cloud client keeps, in order; a configuration.
STORES = [("OneDrive", ["/onedrive"]), ("GoogleDriveSync", ["/google drive", "/googledrive"])]


def source_store(path: Column, stores=STORES) -> Column:
    """The store whose folder a path is in, else Local."""
    low = F.concat(F.lower(path), F.lit("/"))
    hits = [F.when(F.array_max(F.array(*(low.contains(m + "/") for m in marks))), name) for name, marks in stores]
    return F.coalesce(*hits, F.lit("Local"))


def drive_file_id(url: Column) -> Column:
    """The id in a link to a shared file, by its path or else its query; null without one."""
    tried = (r"/file/d/([a-zA-Z0-9_-]+)", r"[?&]id=([a-zA-Z0-9_-]+)")
    return F.coalesce(*(F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in tried))


def folder_cwd(path: Column) -> Column:
    """The working directory that a project folder's name stands for: drive, then parts between hyphens; null without a hyphen."""
    parts = F.split(file_name(F.regexp_replace(path, r"[/\\]+$", "")), "-")
    rest = F.array_join(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(1))), "\\")
    return F.when(F.size(parts) >= 2, F.concat(F.get(parts, F.lit(0)), F.lit(":\\"), rest))


def without_fence(c: Column) -> Column:
    """JSON text without the code fence around it."""
    return strip(F.regexp_replace(strip(text(c)), r"^```[A-Za-z]*\s*|\s*```$", ""))


def message_text(c: Column) -> Column:
    """Message content that is a JSON string or a list of parts: the string, or its text parts joined by spaces; anything else, whatever it starts with, as it is."""
    parts = F.from_json(c, "array<struct<type:string,text:string>>")
    said = F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: text(p["text"]))
    whole = F.get_json_object(F.concat(F.lit('{"x":'), c, F.lit("}")), "$.x")
    return F.coalesce(F.when(F.trim(c).startswith("["), F.array_join(said, " ")).when(F.trim(c).startswith('"'), whole), c)


def one_or_many(c: Column) -> Column:
    """A JSON list, or a JSON or bare scalar, as an array of strings; blank and null are empty."""
    many = F.from_json(c, "array<string>")
    one = F.when(strip(text(c)) == "", F.array().cast("array<string>")).otherwise(F.array(F.regexp_replace(strip(c), r'^"|"$', "")))
    return F.when(F.trim(c).startswith("["), F.coalesce(many, F.array().cast("array<string>"))).otherwise(one)


def nested_or_dotted(columns: dict[str, object], outer: str, inner: str) -> Column:
    """``outer.inner`` of a frame whose column may be a struct, or flat under the dotted name; null if neither is there.

    ``columns`` is {field name: data type} of the frame.
    """
    from pyspark.sql import types as T

    found = []
    kind = columns.get(outer)
    if isinstance(kind, T.StructType) and inner in kind.fieldNames():
        found.append(F.col(f"`{outer}`").getField(inner).cast("string"))
    if f"{outer}.{inner}" in columns:
        found.append(F.col(f"`{outer}.{inner}`").cast("string"))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


#: A line of service on a statement, as a vision model reports it.
SERVICE_RECORDS = "array<struct<service_date:string,description:string,units:bigint,charge:double>>"


def service_records(c: Column) -> Column:
    """The service records of an answer in JSON, fenced or not."""
    return F.from_json(without_fence(c), f"service_records {SERVICE_RECORDS}")["service_records"]


def depth_name(path: Column) -> Column:
    """A directory's name indented by two spaces a level."""
    return F.concat(F.repeat(F.lit("  "), path_depth(path)), file_name(path))


def fold_case(c: Column, insensitive: bool) -> Column:
    """Lower case where names are told apart without case only."""
    return F.lower(c) if insensitive else c


def resolve(names: list[str], wanted: str, words: tuple[str, ...] = ()) -> str | None:
    """The column that is meant: the same name case aside, else the first that holds it, else the first that holds all ``words``."""
    low = [(n, n.lower()) for n in names]
    tests = [lambda x: x == wanted.lower(), lambda x: wanted.lower() in x]
    if words:
        tests.append(lambda x: all(w in x for w in words))
    return next((n for test in tests for n, x in low if test(x)), None)


def typed_schema(names: list[str], integers: set[str]):
    """The schema of a loaded sheet: long for the columns of an allow-list, text for all others."""
    from pyspark.sql import types as T

    return T.StructType([T.StructField(n, T.LongType() if n in integers else T.StringType()) for n in names])
