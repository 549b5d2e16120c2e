"""Secret scans by multipart credential linking.

A first pass over the whole texts finds *parts*, each with a role:

===========  ==========  ======  ==================================================
kind         role        weak    what
===========  ==========  ======  ==================================================
assign       secret      no      a key word, ``:`` or ``=``, a value of 6+ characters
access       identifier  no      ``AKIA`` key ids of 20+ characters
hex          secret      no      24+ hexadecimal digits
identifier   identifier  yes     ``user=...`` and the like, e-mail addresses
secret       secret      yes     bare tokens of 16+ characters of mixed kinds
endpoint     endpoint    yes     URLs, IPv4 addresses, ``host.name:port``
===========  ==========  ======  ==================================================

The first three are always reported.  A weak part alone is noise (any address,
any token), so it is reported only where complementary parts co-occur in its
scope: within ``REACH`` code points in the same paragraph there must be a
strong part of another role, or parts of both other roles.

Co-occurrence is an interval join in Spark: every part covers the bins of
``REACH`` code points from its start to its end plus ``REACH``, and meets the
parts that start in these bins.  The join key is (document, paragraph, bin),
so one very long document is dealt out over all tasks, and as the parts of a
kind do not overlap, a bin holds a bounded number of them.  Pairs are reduced
to two bit sets a part before they are grouped.

Defined results: a null text counts as empty; a text without parts gives an
empty list; documents are rows, so repeated rows and repeated or null ids give
one row each; an empty table gives no rows; columns beyond ``doc_id`` and
``text`` are not read, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dichot.llm.spark import ready, written

#: kinds in the order in which spans of one start are listed
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
#: bits of the roles
IDENTIFIER, SECRET, ENDPOINT = 1, 2, 4
ROLES = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET,
         "identifier": IDENTIFIER, "secret": SECRET, "endpoint": ENDPOINT}
STRONG = KINDS[:3]
#: code points within which parts of one credential stand
REACH = 300

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
NAMED = r"""(user_?name|user|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: what a bare token is made of; one that can matter holds a digit, ``@`` or ``:``
TOKEN = r"[A-Za-z0-9+/_=.:@-]"
LEAST_TOKEN = 7
URL = r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9].*"
ADDRESS = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?"
HOST_PORT = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}"
MAIL = r"[^@:/=]+@[^@:/=]+\.[^@:/.=]+"
OPAQUE = r"[A-Za-z0-9+/_=-]{16,}"
LEAST_DISTINCT = 10
BREAK = r"\n[\x20\x09\r]*\n"

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_NAMED = re.compile(NAMED, re.IGNORECASE | re.ASCII)
_ACCESS, _HEX, _BREAK = re.compile(ACCESS), re.compile(HEX), re.compile(BREAK)
# a run is entered at its start only and scanned at most twice, however long it is
_TOKEN = re.compile(rf"(?<!{TOKEN})(?=[A-Za-z+/_=.-]*+[0-9@:]){TOKEN}{{{LEAST_TOKEN},}}+")
_ENDPOINT = re.compile(f"(?:{URL}|{ADDRESS}|{HOST_PORT})")
_MAIL, _OPAQUE = re.compile(MAIL), re.compile(OPAQUE)
_UPPER, _LOWER, _DIGIT = re.compile("[A-Z]"), re.compile("[a-z]"), re.compile("[0-9]")

PART = "struct<kind: string, start: bigint, stop: bigint, scope: bigint>"


def token_kind(token: str) -> str | None:
    """The weak kind of a bare token, if any."""
    if _ENDPOINT.fullmatch(token):
        return "endpoint"
    if _MAIL.fullmatch(token):
        return "identifier"
    if (_OPAQUE.fullmatch(token) and _UPPER.search(token) and _LOWER.search(token) and _DIGIT.search(token)
            and len(set(token)) >= LEAST_DISTINCT):
        return "secret"
    return None


class _Taken:
    """Spans in order, asked whether another one overlaps them."""

    def __init__(self, spans):
        self.starts, self.stops = [], []
        for start, stop in sorted(spans):
            if self.stops and start < self.stops[-1]:
                self.stops[-1] = max(stop, self.stops[-1])
            else:
                self.starts.append(start)
                self.stops.append(stop)

    def __contains__(self, span) -> bool:
        at = bisect_right(self.starts, span[1] - 1) - 1
        return at >= 0 and self.stops[at] > span[0]


def _keyed(pattern: re.Pattern, words: tuple, least: int, text: str, low: str) -> list[tuple[int, int]]:
    if not ((":" in text or "=" in text) and any(w in low for w in words)):
        return []
    return [m.span() for m in pattern.finditer(text) if m.end(2) - m.start(2) >= least]


def find_parts(text: str) -> list[tuple[str, int, int, int]]:
    """``(kind, start, stop, paragraph)`` of all parts, strong and weak."""
    low = text.lower()
    found = [("assign", *s) for s in _keyed(_ASSIGN, ("passw", "secret", "token", "api"), 6, text, low)]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    strong = _Taken([p[1:] for p in found])
    named = [s for s in _keyed(_NAMED, ("user", "login", "client", "account"), 3, text, low) if s not in strong]
    found += [("identifier", *s) for s in named]
    taken = _Taken([p[1:] for p in found])
    for m in _TOKEN.finditer(text):
        token = m.group()
        start = m.start() + len(token) - len(token.lstrip(".:"))
        token = token.strip(".:")
        if len(token) >= LEAST_TOKEN and (kind := token_kind(token)) and (start, start + len(token)) not in taken:
            found.append((kind, start, start + len(token)))
    if not found:
        return []
    breaks = [m.end() for m in _BREAK.finditer(text)]
    return [(kind, start, stop, bisect_right(breaks, start)) for kind, start, stop in found]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("scope", pa.int64())]))
    for batch in batches:
        texts = batch.column("text")
        parts = [[dict(zip(("kind", "start", "stop", "scope"), p)) for p in find_parts(t.as_py() or "")] for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(parts, part)],
                                         names=["row", "doc_id", "parts"])


def co_occurring(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Pairs of parts of different roles in one scope: of ``parts`` (``row,
    scope, kind, start, stop``) those where the later one starts before the
    earlier one's end plus ``reach``; each pair once, the earlier one first."""
    rank = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    role = F.element_at(F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv)), F.col("kind"))
    parts = parts.withColumn("rank", rank).withColumn("role", role)
    early = parts.select("row", "scope", *(F.col(c).alias(f"a_{c}") for c in ("kind", "start", "stop", "rank", "role")),
                         F.explode(F.sequence(F.floor(F.col("start") / reach), F.floor((F.col("stop") + reach - 1) / reach))).alias("bin"))
    late = parts.select("row", "scope", *(F.col(c).alias(f"b_{c}") for c in ("kind", "start", "stop", "rank", "role")),
                        F.floor(F.col("start") / reach).alias("bin"))
    return early.join(late, ["row", "scope", "bin"]).where(
        (F.col("b_start") < F.col("a_stop") + reach) & (F.col("a_role") != F.col("b_role"))
        & (F.struct("a_start", "a_rank") < F.struct(F.col("b_start").alias("a_start"), F.col("b_rank").alias("a_rank"))))


def confirmed(pairs: DataFrame) -> DataFrame:
    """The weak parts among ``pairs`` with a strong part of another role, or
    parts of both other roles, beside them: ``row, kind, start, stop``."""
    def side(one: str, other: str) -> DataFrame:
        strong = F.col(f"{other}_kind").isin(*STRONG)
        return (pairs.where(~F.col(f"{one}_kind").isin(*STRONG))
                .select("row", *(F.col(f"{one}_{c}").alias(c) for c in ("kind", "start", "stop", "role")),
                        F.col(f"{other}_role").alias("near"), F.when(strong, F.col(f"{other}_role")).otherwise(0).alias("sure")))
    near = side("a", "b").union(side("b", "a")).groupBy("row", "kind", "start", "stop", "role").agg(
        F.bit_or("near").alias("near"), F.bit_or("sure").alias("sure"))
    whole = IDENTIFIER | SECRET | ENDPOINT
    return near.where((F.col("sure") > 0) | (F.col("near").bitwiseOR(F.col("role")) == whole)).select("row", "kind", "start", "stop")


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, spans`` of every document: ``spans`` is an array of ``kind,
    start, stop`` (code points, end exclusive) by start, then kind."""
    ready(docs)
    # the row number is written before it is used, so a lost task cannot change it
    found = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _scan, f"row bigint, doc_id {docs.schema['doc_id'].dataType.simpleString()}, parts array<{PART}>"), "parts")
    weak = F.exists("parts", lambda p: ~p["kind"].isin(*STRONG))
    parts = found.where((F.size("parts") > 1) & weak).select("row", F.explode("parts").alias("p")).select("row", "p.*")
    linked = confirmed(co_occurring(parts, reach)).groupBy("row").agg(
        F.collect_list(F.struct("kind", "start", "stop")).alias("linked"))
    plain = F.transform(F.filter("parts", lambda p: p["kind"].isin(*STRONG)),
                        lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop")))
    order = F.array(*(F.lit(k) for k in KINDS))
    every = F.transform(F.concat(plain, F.coalesce("linked", F.array().cast("array<struct<kind: string, start: bigint, stop: bigint>>"))),
                        lambda p: F.struct(p["start"].alias("start"), F.array_position(order, p["kind"]).alias("rank"),
                                           p["stop"].alias("stop"), p["kind"].alias("kind")))
    return found.join(linked, "row", "left").select("doc_id", F.transform(
        F.array_sort(every), lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["stop"].alias("stop"))).alias("spans"))


def listed(spans: F.Column) -> F.Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["stop"].cast("string"))), ",")
