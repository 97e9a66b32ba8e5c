"""Find secrets with column functions alone: patterns, and entropy of sliding windows.

Three base kinds are found by pattern: a value assigned to a telling name, an access
key id, a long run of hexadecimal digits. Each is leftmost and non-overlapping within its
kind; a match that is too short is dropped, and the search goes on behind it.

The character classes of ``CLASSES`` add spans. A candidate is a run of a class's
characters. A window of ``width`` characters slides over it; one counter per
character of the alphabet is raised for the character that enters and lowered for
the one that leaves, and the sum of c log2 c over the counters, which gives the window's
Shannon entropy, changes by those two terms alone. The added span reaches from the first
window of at least ``bits`` to the end of the last. Sums are whole numbers (2^20 to
the bit), so the order of steps cannot change a decision.

A candidate that an allow-list pattern finds is none: published ids, paths, placeholders,
plain words, plain numbers. An added span that meets a base span goes.

Everything is one projection over the table, without shuffle. Arrays of a row are as long as
its text has matches; running sums take time in proportion to that (times ``BLOCK``).

Null and empty texts have no spans. Positions are code points, end exclusive. Rows
equal in all columns are scanned alike. A column of the table never clashes: the caller
names the result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The base patterns, and the least length of what they must hold.
ASSIGN = (
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*+[:=]\x20*+["']?)([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 8, 16, 32
BASE_KINDS = ("assign", "access", "hex")

ALLOW = (
    r"^[0-9]+$",
    r"^[A-Za-z_=/+-]+$",
    r"(?:^|[^0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?:$|[^0-9A-Fa-f])",
    r"(?i)example|sample|dummy|placeholder|change_?me|your[_-]|redacted",
    r"(?i)^sha(?:1|256|384|512)[-=]",
    r"(?i)0123456789|abcdefghij|qwerty",
    r"(?:^|/)(?:[A-Za-z_-]{2,}[0-9]{0,4}/){2,}",
    r"^(?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4})(?:[_-](?:[A-Za-z]{2,}[0-9]{0,4}|[0-9]{1,4}))+$",
    r"0{8}|1{8}|9{8}|[aA]{8}|[fF]{8}|[xX]{8}|-{8}|_{8}|={8}",
)
SCALE = 1 << 20
#: Elements that one step of a running sum works on.
BLOCK = 256


@dataclass(frozen=True)
class CharClass:
    """Runs of ``alphabet``, judged by windows of ``width`` with at least ``bits`` a character."""

    kind: str
    pattern: str
    alphabet: str
    width: int
    bits: float

    @property
    def terms(self) -> list[int]:
        """c log2 c, scaled, for each count c that a window can hold."""
        return [round(c * math.log2(c) * SCALE) if c else 0 for c in range(self.width + 1)]

    @property
    def limit(self) -> int:
        """The largest sum of terms that a window of enough entropy can have."""
        return round((math.log2(self.width) - self.bits) * self.width * SCALE)


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", r"[0-9A-Fa-f]{20,}", _DIGITS + "abcdefABCDEF", 20, 3.1),
    CharClass(
        "entropy_base64",
        r"[A-Za-z0-9+/_=-]{20,}",
        _DIGITS + _LOWER + _LOWER.upper() + "+/_=-",
        20,
        3.75,
    ),
)
KINDS = BASE_KINDS + tuple(c.kind for c in CLASSES)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What an associative ``step`` makes of all elements before each one.

    Blocks are summed first, so an array grows by one element at a time only within a
    block and over the list of blocks.
    """

    def before(array: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.slice(F.array(start), 1, 0).alias("seen"))

        def add(s: Column, x: Column) -> Column:
            return F.struct(step(s["at"], x).alias("at"), F.array_append(s["seen"], s["at"]).alias("seen"))

        return F.aggregate(array, state, add, lambda s: s["seen"])

    def by_block(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda block: F.aggregate(block, zero, step))
        return F.flatten(F.zip_with(blocks, before(sums, zero), before))

    def cut(array: Column) -> Column:
        last = F.ceil(F.size(array) / BLOCK).cast("int") - 1
        places = F.sequence(F.lit(0), F.greatest(last, F.lit(0)))
        return F.transform(places, lambda i: F.slice(array, i * BLOCK + 1, F.lit(BLOCK)))

    return once(values, lambda array: once(cut(array), by_block))


def located(text: Column, pattern: str) -> Column:
    """All matches as an array of structs: at, value. No match may be empty."""

    def place(found: Column) -> Column:
        values = found["values"]
        gaps = F.slice(found["between"], 1, F.size(values))  # there is one more than matches
        steps = F.zip_with(gaps, values, lambda gap, value: gap + F.length(value))
        before = running(steps, F.lit(0), lambda a, b: a + b)
        at = F.zip_with(gaps, before, lambda gap, passed: gap + passed)
        return F.zip_with(at, values, lambda a, value: F.struct(a.alias("at"), value.alias("value")))

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
        F.transform(F.split(text, pattern, -1), F.length).alias("between"),
    )
    none = F.array().cast("array<struct<at:int,value:string>>")
    return F.when(text.rlike(pattern), once(found, place)).otherwise(none)


def _span(kind: str, start: Column, end: Column, entropy: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        F.lit(KINDS.index(kind)).alias("rank"),
        end.cast("int").alias("end"),
        F.lit(kind).alias("kind"),
        entropy.cast("double").alias("entropy"),
    )


def _whole(kind: str, found: Column) -> Column:
    none = F.lit(None)
    return F.transform(found, lambda m: _span(kind, m["at"], m["at"] + F.length(m["value"]), none))


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, unsorted."""
    assigned = F.filter(
        located(text, ASSIGN),
        lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= ASSIGN_CHARS,
    )
    # A run is too short or not, whatever stands behind it: the length may be in the pattern.
    access = located(text, ACCESS.replace("+", f"{{{ACCESS_CHARS - 4},}}"))
    hexadecimal = located(text, HEX.replace("+", f"{{{HEX_CHARS},}}"))
    found = zip(BASE_KINDS, (assigned, access, hexadecimal))
    return F.concat(*[_whole(kind, matches) for kind, matches in found])


def hottest(value: Column, kind: CharClass) -> Column:
    """Where a candidate's windows of enough entropy begin and end, and the best one's bits.

    A struct of ``first``, ``last`` (null if there is none) and ``least``, the smallest
    sum of terms of any window.
    """
    terms = F.array(*[F.lit(t) for t in kind.terms])
    width = kind.width
    state = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0).alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
        F.lit((1 << 31) - 1).alias("least"),
    )

    def gain(count: Column) -> Column:
        """What the sum gains when a count rises to ``count``."""
        return F.get(terms, count) - F.get(terms, count - 1)

    def step(s: Column, move: Column) -> Column:
        enters, leaves = move["enters"], move["leaves"]
        counts = F.transform(
            s["counts"],
            lambda c, i: c + F.when(i == enters, 1).otherwise(0) - F.when(i == leaves, 1).otherwise(0),
        )
        same = enters == leaves
        lost = F.when(leaves < 0, 0).otherwise(gain(F.get(s["counts"], F.greatest(leaves, F.lit(0)))))
        won = gain(F.get(s["counts"], enters) + 1)
        total = s["sum"] + F.when(same, 0).otherwise(won - lost)
        full = move["at"] >= width - 1
        hot = full & (total <= kind.limit)
        return F.struct(
            counts.alias("counts"),
            total.alias("sum"),
            F.when(hot & s["first"].isNull(), move["at"] - width + 1).otherwise(s["first"]).alias("first"),
            F.when(hot, move["at"] + 1).otherwise(s["last"]).alias("last"),
            F.when(full, F.least(s["least"], total)).otherwise(s["least"]).alias("least"),
        )

    def moves(symbols: Column) -> Column:
        leaves = lambda i: F.when(i >= width, F.get(symbols, i - width)).otherwise(-1)
        return F.transform(
            symbols,
            lambda c, i: F.struct(i.alias("at"), c.alias("enters"), leaves(i).alias("leaves")),
        )

    symbols = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(kind.alphabet), c) - 1)
    found = ("first", "last", "least")
    end = lambda s: F.struct(*[s[name].alias(name) for name in found])
    return F.aggregate(once(symbols, moves), state, step, end)


def added_spans(text: Column, kind: CharClass, allow: tuple[str, ...] = ALLOW) -> Column:
    """The hot stretches of a class's runs that no allow-list pattern finds."""
    symbols = math.ceil(2**kind.bits)  # fewer different ones cannot reach the bits

    def worth(m: Column) -> Column:
        varied = F.size(F.array_distinct(F.split(m["value"], ""))) >= symbols
        known = F.lit(False)
        for pattern in allow:
            known = known | m["value"].rlike(pattern)
        return varied & ~known

    candidates = F.filter(located(text, kind.pattern), worth)
    heated = F.transform(
        candidates, lambda m: F.struct(m["at"].alias("at"), hottest(m["value"], kind).alias("hot"))
    )
    bits = lambda least: F.lit(math.log2(kind.width)) - least / (kind.width * SCALE)
    return F.transform(
        F.filter(heated, lambda m: m["hot"]["first"].isNotNull()),
        lambda m: _span(
            kind.kind,
            m["at"] + m["hot"]["first"],
            m["at"] + m["hot"]["last"],
            F.round(bits(m["hot"]["least"]), 3),
        ),
    )


def apart_from_base(spans: Column) -> Column:
    """Sorted spans without the added ones that meet a base span.

    A base span before an added one meets it if the largest base end so far lies beyond
    its start; one behind it, if the smallest base start to come lies before its end.
    """
    far = (1 << 31) - 1
    is_base = lambda s: s["rank"] < len(BASE_KINDS)

    def kept(array: Column) -> Column:
        ends = F.transform(array, lambda s: F.when(is_base(s), s["end"]).otherwise(0))
        starts = F.transform(array, lambda s: F.when(is_base(s), s["start"]).otherwise(far))
        reached = running(ends, F.lit(0), lambda a, b: F.greatest(a, b))
        coming = F.reverse(running(F.reverse(starts), F.lit(far), lambda a, b: F.least(a, b)))
        near = F.arrays_zip(reached.alias("reached"), coming.alias("coming"))
        apart = lambda s, n: (n["reached"] <= s["start"]) & (n["coming"] >= s["end"])
        marked = F.zip_with(array, near, lambda s, n: F.when(is_base(s) | apart(s, n), s))
        return F.filter(marked, lambda s: s.isNotNull())

    return once(spans, kept)


def find(
    text: Column, classes: tuple[CharClass, ...] = CLASSES, allow: tuple[str, ...] = ALLOW
) -> Column:
    """An array of structs start, rank, end, kind, entropy, by start, then kind as listed.

    ``entropy`` is that of the densest window in bits a character, null for base kinds.
    """
    whole = F.coalesce(text, F.lit(""))
    added = [added_spans(whole, kind, allow) for kind in classes]
    spans = F.concat(base_spans(whole), *added)
    return apart_from_base(F.array_sort(spans)) if classes else F.array_sort(spans)


def as_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches_sql(rank: int, kind: str, pattern: str, least: str) -> str:
    """Rows r, rank, kind, value, start, finish in SQL; ``least`` says which matches count."""
    # Possessive repeats are a matter of speed alone, and not known everywhere.
    quoted = _quoted(pattern.replace("*+", "*"))
    return f"""
        SELECT r, {rank} AS rank, '{kind}' AS kind, vals[i] AS value,
               list_sum([length(x) FOR x IN parts[1:i]]) + coalesce(list_sum([length(x) FOR x IN vals[1:i - 1]]), 0) AS start,
               start + length(vals[i]) AS finish
        FROM (SELECT r, string_split_regex(t, {quoted}) AS parts, regexp_extract_all(t, {quoted}, 0) AS vals FROM docs) AS m,
             LATERAL (SELECT unnest(range(1, len(vals) + 1)) AS i) AS n
        WHERE {least}"""


def _added_sql(kind: CharClass, rank: int) -> str:
    known = " OR ".join(f"regexp_matches(value, {_quoted(p)})" for p in ALLOW)
    runs = _matches_sql(rank, kind.kind, kind.pattern, "true")
    return f"""
        SELECT r, rank, kind, start + list_min(hot) AS start, start + list_max(hot) + {kind.width} AS finish
        FROM (
            SELECT *, [i FOR i IN range(0, length(value) - {kind.width} + 1) IF list_sum(
                [({kind.terms})[c::BIGINT + 1] FOR c IN map_values(list_histogram(
                    string_split(substr(value, i + 1, {kind.width}), '')))]) <= {kind.limit}] AS hot
            FROM ({runs}) AS runs
            WHERE len(list_distinct(string_split(value, ''))) >= {math.ceil(2**kind.bits)} AND NOT ({known})
        ) AS heated WHERE len(hot) > 0"""


def scan_sql() -> str:
    """The spans of ``documents`` by brute force: every window of every candidate counted anew."""
    least = {
        "assign": f"length(regexp_extract(vals[i], {_quoted(ASSIGN.replace('*+', '*'))}, 2)) >= {ASSIGN_CHARS}",
        "access": f"length(vals[i]) >= {ACCESS_CHARS}",
        "hex": f"length(vals[i]) >= {HEX_CHARS}",
    }
    patterns = zip(BASE_KINDS, (ASSIGN, ACCESS, HEX))
    base = " UNION ALL ".join(_matches_sql(i, k, p, least[k]) for i, (k, p) in enumerate(patterns))
    added = " UNION ALL ".join(_added_sql(k, len(BASE_KINDS) + i) for i, k in enumerate(CLASSES))
    text = "string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, rank)"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE_KINDS)
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({base}),
    added AS ({added}),
    spans AS (
        SELECT r, rank, kind, start, finish FROM base
        UNION ALL
        SELECT r, rank, kind, start, finish FROM added WHERE NOT EXISTS (
            SELECT 1 FROM base b WHERE b.r = added.r AND b.start < added.finish AND added.start < b.finish)
    ),
    base_rows AS (SELECT r, {counts}, {text} AS found FROM base GROUP BY r),
    all_rows AS (SELECT r, {text} AS found FROM spans GROUP BY r)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE_KINDS)},
           sha256(coalesce(b.found, '')) AS base_sha256, coalesce(a.found, '') AS spans
    FROM docs LEFT JOIN base_rows b USING (r) LEFT JOIN all_rows a USING (r)"""
