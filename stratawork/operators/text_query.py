"""Queries in words over a full-text index: AND, OR, NOT, phrases, prefixes and English stems."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawork.operators.search import STOP_WORDS, folded

#: Suffixes of English words and what replaces them, by step, of Porter's published rules; fixed values. A step applies its longest suffix that fits.
PLURALS = {"sses": "ss", "ies": "i", "ss": "ss", "s": ""}
DOUBLE = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
SINGLE = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
LAST = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _shape(word: str) -> str:
    """v for each vowel and c for each other letter; y is a vowel after a consonant."""
    out = ""
    for x in word:
        out += "v" if x in "aeiou" or (x == "y" and out.endswith("c")) else "c"
    return out


def _measure(word: str) -> int:
    """How often a vowel is followed by a consonant."""
    return _shape(word).count("vc")


def _short(word: str) -> bool:
    """Ends in consonant, vowel, consonant, the last none of w, x and y."""
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


@lru_cache(maxsize=1 << 16)
def stem(word: str) -> str:
    """The stem of a lower-case English word; words of two letters, or with anything but a to z, stay."""
    if len(word) < 3 or not re.fullmatch("[a-z]+", word):
        return word
    if (s := _longest(word, PLURALS)) is not None:
        word = word[: -len(s)] + PLURALS[s]
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) else word
    elif (s := _longest(word, ("ed", "ing"))) and "v" in _shape(word[: -len(s)]):
        word = word[: -len(s)]
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
            word = word[:-1]
        elif _measure(word) == 1 and _short(word):
            word += "e"
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    for step in (DOUBLE, SINGLE):
        if (s := _longest(word, step)) and _measure(word[: -len(s)]):
            word = word[: -len(s)] + step[s]
    if (s := _longest(word, LAST)) and _measure(word[: -len(s)]) > 1 and (s != "ion" or word[: -len(s)].endswith(("s", "t"))):
        word = word[: -len(s)]
    if word.endswith("e") and (_measure(word[:-1]) > 1 or (_measure(word[:-1]) == 1 and not _short(word[:-1]))):
        word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


@F.pandas_udf(T.StringType())
def _stems(s: pd.Series) -> pd.Series:
    return s.map({w: stem(w) for w in s.dropna().unique()})


def stemmed(idx: DataFrame) -> DataFrame:
    """An index (``search.index``) with the stem of each token beside it."""
    return idx.withColumn("stem", _stems("token"))


@dataclass
class Query:
    """A tree over leaves: a leaf is a list of (offset, word, whether a prefix), a node ("leaf", n), ("not", x), ("and", [..]) or ("or", [..]); None finds nothing to look for."""

    tree: tuple | None = None
    leaves: list[list[tuple[int, str, bool]]] = field(default_factory=list)

    def holds(self, found) -> bool:
        return self.tree is not None and _decide(self.tree, lambda n: n in found, lambda x: not x, all, any)


def _decide(node, leaf, no, every, some):
    kind, of = node
    if kind == "leaf":
        return leaf(of)
    return no(_decide(of, leaf, no, every, some)) if kind == "not" else (every if kind == "and" else some)([_decide(x, leaf, no, every, some) for x in of])


_LEXEME = re.compile(r'"[^"]*"?|<(?:->|\d+>)|[()|&!]|[^\s()|&!"<>]+|<|>')
_WORDS = re.compile(r"[^\W_]+")


def parse(text: str, stop_words=frozenset(STOP_WORDS), marks: bool = True) -> Query:
    """The tree of a query.

    ``&`` or nothing between two terms is AND, ``|`` OR, ``!`` or a leading
    ``-`` NOT, also as the words and, or, not; NOT binds most, then ``<->``
    and ``<n>`` (follows, n places on), AND, OR. Quoted words and words with
    marks inside (``W-9``) are phrases, ``word*`` or ``word:*`` a prefix. Stop
    words go, and keep their places in a phrase. Unbalanced parentheses,
    operators without a term and ``<->`` beside anything but words raise
    ValueError. Words are folded as in an index with the same ``marks``.
    """
    q, at = Query(), 0
    lexemes = _LEXEME.findall(text)
    operator = lambda x: {"and": "&", "or": "|", "not": "!"}.get(x.lower(), x)
    lexemes = [x if x.startswith('"') else operator(x) for x in lexemes]

    def peek() -> str:
        return lexemes[at] if at < len(lexemes) else ""

    def take() -> str:
        nonlocal at
        at += 1
        return lexemes[at - 1]

    def leaf(term: str):
        prefix = not term.startswith('"') and re.search(r":?\*$", term) is not None
        words = [folded(w) if marks else w.lower() for w in _WORDS.findall(term)]
        kept = [(k, w, prefix and k == len(words) - 1) for k, w in enumerate(words)]
        kept = [x for x in kept if x[2] or x[1] not in stop_words]
        if not kept:
            return None
        q.leaves.append(kept)
        return ("leaf", len(q.leaves) - 1)

    def unary():
        x = peek()
        if x in ("", ")", "|", "&") or x.startswith("<") or x == ">":
            raise ValueError(f"a term is missing before {x or 'the end'!r}")
        take()
        if x == "!" or (x.startswith("-") and len(x) > 1):
            if x != "!":
                lexemes.insert(at, x[1:])
            inner = unary()
            return inner and ("not", inner)
        if x == "(":
            inner = either()
            if peek() != ")":
                raise ValueError("a parenthesis is open")
            take()
            return inner
        return leaf(x)

    def follows():
        node = unary()
        while peek().startswith("<") and peek() != "<":
            gap = take().strip("<->")
            behind = unary()
            if node is None or behind is None:
                node = node or behind
                continue
            if node[0] != "leaf" or behind[0] != "leaf":
                raise ValueError("only words and phrases can follow one another")
            first, second = q.leaves[node[1]], q.leaves.pop()
            start = first[-1][0] + (int(gap) if gap else 1) - second[0][0]
            q.leaves[node[1]] = first + [(start + k, w, p) for k, w, p in second]
        return node

    def joined(kind: str, part, goes_on):
        nodes = [part()]
        while goes_on():
            nodes.append(part())
        nodes = [n for n in nodes if n is not None]
        return (kind, nodes) if len(nodes) > 1 else nodes[0] if nodes else None

    def another() -> bool:
        if peek() == "&":
            take()
            return True
        return peek() not in ("", ")", "|")

    def alternative() -> bool:
        return peek() == "|" and bool(take())

    def either():
        return joined("or", lambda: joined("and", follows, another), alternative)

    if lexemes:
        q.tree = either()
        if at < len(lexemes):
            raise ValueError(f"not expected: {lexemes[at]!r}")
    return q


def matching(idx: DataFrame, key: str, query: str | Query, keys: DataFrame | None = None, stems: bool = True, marks: bool = True) -> DataFrame:
    """The keys that a query finds in an index (token, ``key``, col, pos; with ``stems`` also stem, see ``stemmed``).

    Entries of the query's words are turned into the places where a leaf could
    start; a leaf is found where all its words name one place of one column,
    and the tree is decided on the set of a key's leaves. A query that holds
    for a text without any of its words (NOT alone) is decided for all
    ``keys``, which it then needs. A query of stop words alone finds nothing.
    ``marks`` is that of the index.
    """
    q = parse(query, marks=marks) if isinstance(query, str) else query
    if q.tree is None:
        return idx.select(key).limit(0)
    asked = F.array(*(F.struct(F.lit(n).alias("leaf"), F.lit(k).alias("k"), F.lit(stem(w) if stems and not p else w).alias("w"), F.lit(p).alias("prefix")) for n, leaf in enumerate(q.leaves) for k, w, p in leaf))
    word = F.col("stem" if stems else "token")
    own = F.filter(asked, lambda x: F.when(x["prefix"], F.col("token").startswith(x["w"])).otherwise(word == x["w"]))
    some = F.lit(False)
    for _, w, p in {x for leaf in q.leaves for x in leaf}:
        some = some | (F.col("token").startswith(w) if p else word == (stem(w) if stems else w))
    starts = idx.filter(some).select(key, "col", "pos", F.explode(own).alias("x")).select(key, "col", (F.col("pos") - F.col("x.k")).alias("p"), F.col("x.leaf").alias("leaf"))
    size = F.array(*(F.lit(len(leaf)) for leaf in q.leaves))
    whole = starts.groupBy(key, "col", "leaf", "p").agg(F.count("*").alias("n")).filter(F.col("n") == F.element_at(size, F.col("leaf") + 1))
    found = whole.groupBy(key).agg(F.collect_set("leaf").alias("found"))  # at most the leaves of the query
    if q.holds(set()):
        if keys is None:
            raise ValueError("this query also finds texts without any of its words: it needs all keys")
        found = keys.select(key).distinct().join(found, key, "left").withColumn("found", F.coalesce("found", F.array().cast("array<int>")))

    def together(parts: list[Column], how) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = how(out, p)
        return out

    ok = _decide(q.tree, lambda n: F.array_contains("found", n), lambda x: ~x, lambda p: together(p, lambda a, b: a & b), lambda p: together(p, lambda a, b: a | b))
    return found.filter(ok).select(key)
