r"""Operator 11, secret scan by multipart credential linking, with DataFrame
functions only.

A credential has complementary parts: an access identifier, a secret and an
endpoint.  ``KINDS`` lists the patterns of parts; strong kinds are reported
wherever they stand, weak ones (a login name, a random-looking word, a URL, a
host) only where complementary parts co-occur: within ``reach`` code points
of each other and in one scope, the text between two blank lines.  A weak
identifier needs a secret, a weak secret an identifier, an endpoint a secret
that is itself reported.

Parts are found by splitting a text at a kind's matches: the lengths of gaps
and matches, summed in order, are the places, and blank lines counted in the
gaps the scopes (no part holds a line break).  Texts are read once and never
shuffled.  Parts that may be complementary meet in an interval join: a part's
reach is dealt into bins of ``reach`` code points, and a left semi join on
document, scope and bin keeps the weak parts with a partner.  A bin holds no
more parts than fit in its code points, so neither a hot document nor a hot
scope makes a large group, and a part is a row once however many partners it
has.

Inputs: a null text counts as empty; an empty text has no parts.  Very long
texts are split whole; only numbers leave them.  Matches are leftmost and do
not overlap within a kind; spans of different kinds may overlap or tie, and
stand by start, then kind as listed.  Repeated rows and rows that share a
doc_id or have none are documents of their own.  Other columns are ignored,
whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakemarts.llm.common import stored, union

REACH = 200
#: Ends a scope: a line break, then lines of blanks.
SCOPE_BREAK = r"\n(?:[\x20\t\r]*\n)+"

_ASSIGNED = r"""["']?\x20*[:=]\x20*["']?"""


def any_case(words: str) -> str:
    """A pattern's letters in either case, A-Z only."""
    return "".join(f"[{c.upper()}{c}]" if "a" <= c <= "z" else c for c in words)


@dataclass(frozen=True)
class Kind:
    """``role`` is secret, access or endpoint.  A match counts if its part
    behind ``lead`` has ``least`` characters and it meets all of ``has``."""

    name: str
    role: str
    strong: bool
    pattern: str
    lead: str = ""
    least: int = 1
    has: tuple[str, ...] = ()


def _assignment(names: str, value: str) -> tuple[str, str]:
    lead = any_case(names) + _ASSIGNED
    return lead + value, lead


_SECRET = _assignment("(?:password|passwd|secret|token|api_?key)", "[A-Za-z0-9+/_.=-]+")
_LOGIN = _assignment("(?:user(?:name)?|login|client_?id|account|access_?key(?:_?id)?)", "[A-Za-z0-9@+/_.-]+")
_HOST = _assignment("(?:host(?:name)?|endpoint|server)", "[A-Za-z0-9.-]+(?::[0-9]+)?")

#: Runs are matched from their first character, so none is tried twice.
KINDS = (
    Kind("assign", "secret", True, _SECRET[0], _SECRET[1], 6),
    Kind("access", "access", True, "AKIA[A-Z0-9]{16,}"),
    Kind("hex", "secret", True, "(?<![0-9a-f])[0-9a-f]{24,}"),
    Kind("login", "access", False, _LOGIN[0], _LOGIN[1], 3),
    Kind(
        "random", "secret", False, "(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}",
        has=("[a-z]", "[A-Z]", "[0-9]"),
    ),
    Kind(
        "url", "endpoint", False,
        r"""(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|rediss?|amqps?)://[^\x00-\x20"'<>]+""",
    ),
    Kind("host", "endpoint", False, _HOST[0], _HOST[1], 4),
)

_SPAN = ["row", "kind", "start", "end", "scope"]


def _counts(match: Column, kind: Kind) -> Column:
    value = F.regexp_replace(match, f"^{kind.lead}", "") if kind.lead else match
    ok = F.char_length(value) >= kind.least
    for pattern in kind.has:
        ok = ok & F.regexp_like(match, F.lit(pattern))
    return ok


def _pieces(gaps: Column, matches: Column, number: int, kind: Kind) -> Column:
    """A kind's matches with the lengths that place them."""
    pairs = F.zip_with(
        F.slice(gaps, 1, F.size(matches)), matches,
        lambda gap, match: F.struct(
            F.char_length(gap).alias("gap"), F.char_length(match).alias("length"), _counts(match, kind).alias("ok"),
            F.regexp_count(gap, F.lit(SCOPE_BREAK)).alias("breaks"),
        ),
    )
    return F.transform(
        pairs,
        lambda p, at: F.struct(
            F.lit(number).alias("kind"), at.alias("at"), p["gap"].alias("gap"), p["length"].alias("length"),
            p["ok"].alias("ok"), p["breaks"].alias("breaks"),
        ),
    )


def _matched(docs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """``row, doc_id, pieces``: every document with its matches."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for i, kind in enumerate(kinds):
        rows = rows.withColumn(f"m{i}", F.regexp_extract_all("text", F.lit(kind.pattern), 0))
    # a text without matches of a kind is not split
    none = F.array().cast("array<string>")
    for i, kind in enumerate(kinds):
        gaps = F.when(F.size(f"m{i}") > 0, F.split("text", kind.pattern, -1)).otherwise(none)
        rows = rows.withColumn(f"g{i}", gaps)
    pieces = [_pieces(F.col(f"g{i}"), F.col(f"m{i}"), i, kind) for i, kind in enumerate(kinds)]
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.concat(*pieces).alias("pieces"))


def _placed(matched: DataFrame) -> DataFrame:
    """Spans ``row, kind, start, end, scope`` in code points, end exclusive."""
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    rows = matched.select("row", F.inline("pieces"))
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far)).withColumn(
        "scope", F.sum("breaks").over(so_far)
    )
    return ends.where("ok").select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end", "scope")


def _bins(first: Column, last: Column, reach: int) -> Column:
    return F.explode(F.sequence(F.floor(first / reach), F.floor(last / reach)))


def near(some: DataFrame, others: DataFrame, reach: int) -> DataFrame:
    """The spans of ``some`` that have one of ``others`` in the same document
    and scope, with at most ``reach`` code points between."""
    left = some.withColumn("bin", _bins(F.col("start") - reach, F.col("end") + reach, reach))
    right = others.select(
        "row", "scope", F.col("start").alias("from"), F.col("end").alias("to"),
        _bins(F.col("start"), F.col("end"), reach).alias("bin"),
    )
    close = (F.col("from") - F.col("l.end") <= reach) & (F.col("l.start") - F.col("to") <= reach)
    same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("row", "scope", "bin")]
    found = left.alias("l").join(right.alias("r"), [*same, close], "left_semi")
    return found.select(*_SPAN).distinct()


def linked_parts(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, reach: int = REACH) -> tuple[DataFrame, DataFrame]:
    """Documents ``row, doc_id`` and reported spans ``row, kind, start, end,
    scope``; ``kind`` is the place in ``kinds``."""
    matched = stored(_matched(docs, kinds), "credentials-matched")
    spans = stored(_placed(matched.where(F.size("pieces") > 0)), "credentials-spans")

    def of(role: str, *strong: bool) -> DataFrame:
        wanted = [i for i, k in enumerate(kinds) if k.role == role and k.strong in strong]
        return spans.where(F.col("kind").isin(wanted))

    weak_access = near(of("access", False), of("secret", True, False), reach)
    weak_secrets = near(of("secret", False), of("access", True, False), reach)
    secrets = of("secret", True).unionByName(weak_secrets)
    endpoints = near(of("endpoint", False), secrets, reach)
    reported = union([secrets, of("access", True), weak_access, of("endpoint", True), endpoints])
    return matched.select("row", "doc_id"), reported


def _listed(spans: Column, kinds: tuple[Kind, ...]) -> Column:
    names = F.array(*(F.lit(k.name) for k in kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def secret_spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, reach: int = REACH) -> DataFrame:
    """One row per document: ``doc_id``, ``found`` (array of ``start, kind,
    end`` in order, kind being its place in ``kinds``), ``spans`` (the same as
    text ``kind:start:end``, comma-joined) and ``strong_spans`` (its strong
    kinds)."""
    rows, reported = linked_parts(docs, kinds, reach)
    grouped = reported.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    every = rows.join(grouped, "row", "left").withColumn("found", F.coalesce("found", none))
    strong = [i for i, k in enumerate(kinds) if k.strong]
    return every.select(
        "doc_id", "found", _listed(F.col("found"), kinds).alias("spans"),
        _listed(F.filter("found", lambda s: s["kind"].isin(strong)), kinds).alias("strong_spans"),
    )
