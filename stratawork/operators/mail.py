"""Message bodies: how a reply quotes, where it came from, cutting the quote, and signatures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratawork.functions.html import html_to_text, strip_gmail

#: How a body is told to quote, as patterns over the body; fixed values.
INLINE = r"(?i)\binline\b"
FORWARD_SUBJECT = r"(?i)^\s*fwd?\s*[:\-]"
GT_LINE = r"(?m)^>"
ORIGINAL_LINE = r"(?im)^-{3,}.*original message.*-{3,}"
HEADER_LINES = r"(?im)^From:\s.+\n(Subject|Date|Sent):"
ON_WROTE_ANYWHERE = r"(?i)On .{5,100} wrote:"
#: Boundaries of quoted messages, as patterns that start with the line break before them; fixed values.
FORWARD_DASHES = r"(?i)\n[ \t]*-{4,}[ \t]*(?:Forwarded|Original)\s+messages?[ \t]*-{4,}"
FORWARD_BEGIN = r"(?i)\nBegin\s+forwarded\s+message\s*:"
OUTLOOK = r"(?i)\nFrom:[ \t]+\S[^\n]*\n(?:Sent|Date):[ \t]"
ORIGINAL = r"(?i)\n-----Original Message-----"
ON_WROTE = r"(?i)\nOn .{5,}wrote:"
IOS_ON_AT = r"(?i)\nOn [A-Za-z]+ \d{1,2}, \d{4}, at \d{1,2}:\d{2}(?:\s*[AP]M)?,"
MOBILE_HEADER = r"(?i)\nFrom:[ \t]+\"[^\"]{1,80}\"[ \t]+<[^>]{1,80}>\s*\n(?:Subject|Date|To):[ \t]"
ANNOUNCES = r"(?i)^On .{5,}wrote:\s*$"
#: (trigger pattern, domain that the sender must have or None for all, lines of a name block above it at most); synthetic names.
SIGNATURES = [
    (r"(?i)\nExample Corp", "example.com", 5),
    (r"(?i)\nGet Outlook for iOS", None, 0),
    (r"(?i)\nThe information contained in this transmission", None, 0),
    (r"(?i)\nThis e-mail message, including any attachments", None, 0),
]

ENDS = r"^\s+|\s+$"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, ENDS, "")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` uses it and in whatever branches."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def strip_method(subject: Column, text: Column, html: Column, in_reply_to: Column) -> Column:
    """How a body quotes, by ordered rules over the sender's text, the markup, the subject and whether it answers anything."""
    t, h, s = _text(text), _text(html), _text(subject)
    answers = _trim(_text(in_reply_to)) != ""
    rules = [
        (t.rlike(INLINE), "Inline"),
        (s.rlike(FORWARD_SUBJECT), "Forward"),
        (F.lower(h).contains("gmail_quote"), "Gmail"),
        (h.contains("MsoNormal"), "Outlook"),
        (t.rlike(GT_LINE), "GT_Prefix"),
        (h.contains('dir="auto"') & answers, "iOS"),
        (t.rlike(ORIGINAL_LINE) | t.rlike(HEADER_LINES), "Outlook_Plain"),
        (t.rlike(ON_WROTE_ANYWHERE), "OnWrote"),
        (~answers, "Original"),
    ]
    return F.coalesce(*(F.when(hit, name) for hit, name in rules), F.lit("Clean_Reply"))


def source_kind(thread_id: Column, file: Column) -> Column:
    """GMAIL_API if there is a thread id, else by the file's extension MSG_FILE or EML_FILE."""
    return F.when(_trim(_text(thread_id)) != "", "GMAIL_API").when(F.lower(_text(file)).endswith(".msg"), "MSG_FILE").otherwise("EML_FILE")


def has_boundary(text: Column, pattern: str) -> Column:
    return F.concat(F.lit("\n"), _text(text)).rlike(pattern)


def cut(text: Column, pattern: str) -> Column:
    """What is before the first match; a boundary may be the first line."""
    whole = F.concat(F.lit("\n"), _text(text))
    return _trim(F.get(F.split(whole, pattern, 2), F.lit(0)))


def first_cut(text: Column, *patterns: str) -> Column:
    """Cut at the first pattern, in their order, that is found; without one the text, trimmed."""
    return F.coalesce(*(F.when(has_boundary(text, p), cut(text, p)) for p in patterns), _trim(_text(text)))


def strip_outlook(text: Column) -> Column:
    """Cut at an Outlook header, which has to be on a line after the first."""
    return _trim(F.get(F.split(_text(text), OUTLOOK, 2), F.lit(0)))


def strip_forward(text: Column) -> Column:
    return first_cut(text, FORWARD_DASHES, FORWARD_BEGIN, OUTLOOK)


def strip_gt(text: Column) -> Column:
    """Without quoted lines and the lines that announce them; runs of blank lines become one."""
    plain = F.regexp_replace(_text(text), r"\r\n?", "\n")
    lines = F.filter(F.split(plain, "\n"), lambda x: ~x.startswith(">") & ~x.rlike(ANNOUNCES))
    return _trim(F.regexp_replace(F.array_join(lines, "\n"), r"\n(?:[^\S\n]*+\n)++", "\n\n"))


def strip_outlook_plain(text: Column) -> Column:
    return F.when(has_boundary(text, ORIGINAL), cut(text, ORIGINAL)).otherwise(strip_outlook(text))


def strip_ios(text: Column, plain: Column | None = None) -> Column:
    """Cut at a mobile client's header in the text, else in the plain body, else as a forward."""
    tried = [text] if plain is None else [text, plain]
    found = [F.when(has_boundary(c, p), cut(c, p)) for c in tried for p in (IOS_ON_AT, MOBILE_HEADER)]
    return F.coalesce(*found, strip_forward(text))


def walk_back(text: Column, most: int) -> Column:
    """Without the block of name and title lines at the end: up to the blank line before it, ``most`` lines at most."""
    lines = F.split(F.regexp_replace(text, r"\s+$", ""), "\n")
    last_blank = F.array_max(F.transform(lines, lambda x, i: F.when(~x.rlike(r"\S"), i + 1).otherwise(0)))
    return F.array_join(F.slice(lines, F.lit(1), F.greatest(last_blank, F.size(lines) - most, F.lit(0))), "\n")


def strip_signature(text: Column, sender: Column | None = None, triggers=SIGNATURES) -> Column:
    """Cut at the first trigger, in their order, that is found and whose domain the sender has; then name lines above it go."""
    who = _text(sender) if sender is not None else F.lit("")

    def signed(plain: Column) -> Column:
        found = []
        for pattern, domain, lines in triggers:
            hit = plain.rlike(pattern)
            if domain is not None:
                hit = F.lower(who).contains(domain) & hit
            before = F.get(F.split(plain, pattern, 2), F.lit(0))
            found.append(F.when(hit, _trim(walk_back(before, lines) if lines else before)))
        return F.coalesce(*found, _trim(plain))

    return let(F.regexp_replace(_text(text), r"\r\n?", "\n"), signed)


def body_clean(method: Column, text: Column, html: Column | None = None, sender: Column | None = None, triggers=SIGNATURES) -> Column:
    """The body without its quote, by method, and then without its signature.

    Methods that cut work on the text of the markup where there is any, else
    on the plain text; Inline, Original and Clean_Reply keep the plain text.
    """
    plain = _text(text)
    body = plain
    gmail = plain
    if html is not None:
        marked = _text(html) != ""
        body = F.when(marked, html_to_text(_text(html))).otherwise(plain)
        gmail = F.when(marked, strip_gmail(_text(html))).otherwise(plain)

    def cleaned(r: Column) -> Column:
        b = r["body"]
        by_method = {
            "Gmail": r["gmail"],
            "Outlook": strip_outlook(b),
            "Forward": strip_forward(b),
            "GT_Prefix": strip_gt(b),
            "Outlook_Plain": strip_outlook_plain(b),
            "iOS": strip_ios(b, r["plain"] if html is not None else None),
            "OnWrote": first_cut(b, ON_WROTE),
        }
        return F.coalesce(*(F.when(r["method"] == m, c) for m, c in by_method.items()), r["plain"])

    each = F.struct(method.alias("method"), plain.alias("plain"), body.alias("body"), gmail.alias("gmail"))
    return strip_signature(let(each, cleaned), sender, triggers)
