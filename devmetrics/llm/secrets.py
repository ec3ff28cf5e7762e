"""Secret scan (DataFrame operations only): three patterns, and strings of high entropy.

Patterns give the kinds assign, access and hex. For the kind entropy, candidates are runs of at least ``WINDOW``
characters of ``[A-Za-z0-9+/_=-]``. What the allow-list matches is cut out of them. A piece with a digit, a lower-case
and an upper-case letter is judged whole (class mixed); any other piece by its runs of letters and digits: hexadecimal
ones, and those of one case where digits and letters alternate. A window of ``WINDOW`` characters slides over what is
judged; its Shannon entropy is kept up to date from the counts of the character that leaves and the one that comes in.
The span goes from the first to the last window that reaches the threshold of the class. Spans inside one that a
pattern found are left out.

A text is cut at the matches of a pattern, so that running sums over the lengths of the parts give the places; all
places are in code points, ends exclusive. Work grows with the text and, by a logarithm more, with its matches.

Defined cases: null and empty text: no spans (the digest of the empty string); repeated rows are scanned row by row;
spans of one start come in the order of kinds; very long texts are scanned whole; empty table: empty result; extra
columns pass through ``with_secrets``, whatever their names, null ids too.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.common import free_names

#: The patterns and the kinds in their order. Group 2 of assign has 6 characters or more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
#: A text without any of these holds no match of assign.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
RUN = "[A-Za-z0-9]{20,}"
#: The characters of candidates.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Allow-list: documentation samples, placeholders, runs of the alphabet or of digits, UUIDs, six equal characters.
ALLOWED = ("(?i:example|sample|dummy|placeholder|your[_-]|abcdefgh)|01234567|12345678"
           "|[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}|"
           + "|".join(f"[{c}]{{6,}}" if c != "-" else "-{6,}" for c in ALPHABET))
#: Class of pieces that are judged whole, and its threshold in bits.
MIXED = (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 3.6)
#: Classes of runs of letters and digits.
RUNS = ((r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 2.8),
        (r"^(?=.*[0-9][a-z]+[0-9])[a-z0-9]+$", 3.5),
        (r"^(?=.*[0-9][A-Z]+[0-9])[A-Z0-9]+$", 3.5))

#: Sums of count * log2(count) are kept as whole numbers of this many parts, so that they don't drift.
_PARTS = 1 << 40
#: Counts of characters (20 at most, five bits) in one long.
_PER_WORD = 12
#: Characters of a text that are masked at a time.
_BLOCK, _LARGE = 1 << 15, 1 << 20

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_PLACED = "array<struct<start:int,text:string>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, combine: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running sums (or maxima) of an array of whole numbers: each step combines with what stands twice as far before."""
    def of(v: Column) -> Column:
        steps = F.when(F.size(v) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(v).cast("double"))).cast("int") - 1))

        def step(acc: Column, k: Column) -> Column:
            by = F.call_function("shiftleft", F.lit(1), k)
            return F.zip_with(acc, F.concat(F.array_repeat(F.lit(zero), by), F.slice(acc, F.lit(1), F.size(acc) - by)), combine)

        return F.aggregate(F.coalesce(steps, F.array().cast("array<int>")), v, step)

    return let(values, of)


def parts(text: Column, pattern: str, gaps: bool = False) -> Column:
    """(start, text) of all matches of a pattern, or of all ``gaps`` before, between and behind them."""
    def placed(found: Column) -> Column:
        def both(cut: Column) -> Column:
            ends = running(F.zip_with(F.slice(cut, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m)), lambda a, b: a + b, 0)
            if gaps:
                return F.zip_with(F.concat(F.array(F.lit(0)), ends), cut, lambda e, g: F.struct(e.alias("start"), g.alias("text")))
            return F.zip_with(ends, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), m.alias("text")))

        return let(F.split(text, pattern, -1), both)

    none = F.array(F.struct(F.lit(0).alias("start"), text.alias("text"))) if gaps else F.array()
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(none.cast(_PLACED)))


def spans_of(placed: Column, kind: int) -> Column:
    return F.transform(placed, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), (p["start"] + F.length(p["text"])).alias("end")))


def entropy_window(candidate: Column, threshold: Column) -> Column:
    """(first, last): starts of the first and the last window that reach the threshold, null if none does.

    The state holds a count for each character of the alphabet, packed into longs, and the sum of
    count * log2(count) over them. A step takes one character out and one in."""
    sums = F.array(*[F.lit(round(n * math.log2(n) * _PARTS) if n else 0) for n in range(WINDOW + 2)])
    state = lambda words, total, first, last: F.struct(
        words.alias("words"), total.alias("total"), first.alias("first"), last.alias("last"))

    def body(codes: Column) -> Column:
        word, shift = (lambda c: (c / _PER_WORD).cast("int")), (lambda c: c % _PER_WORD * 5)
        unit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), shift(c))
        count = lambda words, c: F.call_function("shiftright", F.get(words, word(c)), shift(c)).bitwiseAND(31).cast("int")
        gain = lambda n: F.get(sums, n + 1) - F.get(sums, n)

        def add(s: Column, c: Column) -> Column:
            words = F.transform(s["words"], lambda w, j: w + F.when(j == word(c), unit(c)).otherwise(0))
            return state(words, s["total"] + gain(count(s["words"], c)), s["first"], s["last"])

        def moved(s: Column, out: Column, new: Column) -> Column:
            words = F.transform(s["words"], lambda w, j: w + F.when(j == word(new), unit(new)).otherwise(0) - F.when(j == word(out), unit(out)).otherwise(0))
            total = s["total"] + gain(count(s["words"], new)) - gain(count(s["words"], out) - 1)
            return F.when(out == new, s).otherwise(state(words, total, s["first"], s["last"]))

        def judged(s: Column, start: Column) -> Column:
            high = s["total"] <= (F.lit(math.log2(WINDOW)) - threshold + 1e-9) * WINDOW * _PARTS
            return state(s["words"], s["total"], F.when(high, F.coalesce(s["first"], start)).otherwise(s["first"]),
                         F.when(high, start).otherwise(s["last"]))

        none = F.lit(None).cast("int")
        begin = state(F.array_repeat(F.lit(0).cast("long"), -(-len(ALPHABET) // _PER_WORD)), F.lit(0).cast("long"), none, none)
        filled = F.aggregate(F.slice(codes, 1, WINDOW), begin, add)
        moves = F.when(F.size(codes) > WINDOW, F.sequence(F.lit(1), F.size(codes) - WINDOW)).otherwise(F.array().cast("array<int>"))
        slide = lambda s, i: let(moved(s, F.get(codes, i - 1), F.get(codes, i + WINDOW - 1)), lambda u: judged(u, i))
        return let(filled, lambda s: F.aggregate(moves, judged(s, F.lit(0)), slide))

    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    found = let(codes, body)
    return F.struct(found["first"].alias("first"), found["last"].alias("last"))


def entropy_spans(text: Column) -> Column:
    """Spans of the kind entropy."""
    inside = lambda whole, cut: F.flatten(F.transform(whole, lambda p: F.transform(
        cut(p["text"]), lambda q: F.struct((p["start"] + q["start"]).alias("start"), q["text"].alias("text")))))
    long = lambda placed: F.filter(placed, lambda p: F.length(p["text"]) >= WINDOW)
    whole = lambda t: F.array(F.struct(F.lit(0).alias("start"), t.alias("text")))
    allowed = lambda t: F.when(t.rlike(ALLOWED), parts(t, ALLOWED, gaps=True)).otherwise(whole(t))
    runs = lambda t: F.when(t.rlike(MIXED[0]), whole(t)).otherwise(parts(t, RUN))

    def threshold(c: Column) -> Column:
        found = F.lit(None).cast("double")
        for pattern, bits in reversed((MIXED, *RUNS)):
            found = F.when(c.rlike(pattern), bits).otherwise(found)
        return F.when(~c.rlike("^[0-9a-f]{24,}$"), found)  # (those are spans of the kind hex already)

    def judged(p: Column) -> Column:
        window = let(threshold(p["text"]), lambda t: F.when(t.isNotNull(), entropy_window(p["text"], t)))
        return let(window, lambda w: F.struct((p["start"] + w["first"]).alias("start"), F.lit(len(KINDS)).alias("kind"),
                                              (p["start"] + w["last"] + WINDOW).alias("end")))

    def of(candidates: Column) -> Column:
        pieces = long(inside(long(inside(candidates, allowed)), runs))
        return F.filter(F.transform(pieces, judged), lambda s: s["start"].isNotNull())

    return let(parts(text, CANDIDATE), lambda c: F.when(F.size(c) > 0, of(c)).otherwise(F.array().cast(_SPANS)))


def all_spans(text: Column) -> Column:
    """All spans of a text (not null), by start and then kind: array of (start, kind from 1, end)."""
    lower = F.lower(text)
    named = lower.contains(KEYWORDS[0])
    for word in KEYWORDS[1:]:
        named = named | lower.contains(word)
    none = F.array().cast(_SPANS)
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long = lambda placed: F.zip_with(placed, values, lambda p, v: F.when(F.length(v) >= 6, p))
    assign = F.when(named, spans_of(F.filter(long(parts(text, ASSIGN)), lambda p: p.isNotNull()), 1)).otherwise(none)
    access = F.when(text.contains("AKIA"), spans_of(parts(text, ACCESS.replace("+", "{16,}")), 2)).otherwise(none)
    hexes = spans_of(parts(text, HEX.replace("+", "{24,}")), 3)

    def uncovered(spans: Column) -> Column:
        """Without those of the kind entropy that end by the end of a pattern's span that begins before them."""
        reach = running(F.transform(spans, lambda s: F.when(s["kind"] < len(KINDS), s["end"]).otherwise(-1)), lambda a, b: F.greatest(a, b), -1)
        return let(reach, lambda r: F.filter(spans, lambda s, i: (s["kind"] < len(KINDS)) | (F.get(r, i) < s["end"])))

    return let(F.sort_array(F.concat(assign, access, hexes, entropy_spans(text))), lambda s: F.when(F.size(s) > 1, uncovered(s)).otherwise(s))


def with_secrets(docs: DataFrame, name: str = "__spans") -> DataFrame:
    """``docs`` with a column of spans, see ``all_spans``; an extra column of that name is replaced."""
    return docs.withColumn(name, all_spans(F.coalesce(F.col("text"), F.lit(""))))


def joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans of every row of (doc_id, text)."""
    found = with_secrets(docs.select("doc_id", "text"))
    spans = F.col("__spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(i + 1).alias(f"n_{k}") for i, k in enumerate(KINDS)),
                        F.sha2(joined(F.filter(spans, lambda s: s["kind"] <= 3)), 256).alias("base_sha256"),
                        joined(spans).alias("spans"))


def stretches(spans: Column) -> Column:
    """Sorted spans that overlap as one: array of (a, b)."""
    def of(reach: Column) -> Column:
        first = F.filter(F.transform(spans, lambda s, i: F.when((i == 0) | (s["start"] >= F.get(reach, i - 1)), F.struct(s["start"].alias("a"), i.alias("i")))),
                         lambda x: x.isNotNull())
        last = lambda f, i: F.coalesce(F.get(f, i + 1)["i"], F.size(spans)) - 1
        return let(first, lambda f: F.transform(f, lambda x, i: F.struct(x["a"].alias("a"), F.get(reach, last(f, i)).alias("b"))))

    return let(running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), -1), of)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch covered by spans (sorted) replaced by ``mark``.

    Worked on in large blocks of small blocks, as a place in a text is found from its start, and the stretches of a
    block from all: a stretch belongs to the block it begins in, and what goes on into the next one is left out there."""
    def block(part: Column, at: Column, every: Column) -> Column:
        end = at + F.length(part)
        here = F.transform(F.filter(every, lambda s: (s["a"] < end) & (s["b"] > at)), lambda s: F.struct(
            F.greatest(s["a"] - at, F.lit(0)).alias("a"), F.least(s["b"], end).alias("b"), (s["a"] >= at).alias("new")))

        def masked(h: Column) -> Column:
            before = lambda i: F.when(i > 0, F.get(h, i - 1)["b"] - at).otherwise(0)
            kept = F.transform(h, lambda s, i: F.concat(F.substring(part, before(i) + 1, s["a"] - before(i)), F.when(s["new"], mark).otherwise("")))
            return F.concat(F.array_join(kept, ""), F.substring(part, before(F.size(h)) + 1, F.length(part)))

        return let(here, masked)

    def whole(every: Column) -> Column:
        cut = lambda c, n: F.regexp_extract_all(c, F.lit(f"(?s).{{1,{n}}}"), F.lit(0))
        near = lambda at, n: F.filter(every, lambda s: (s["a"] < at + n) & (s["b"] > at))

        def large(part: Column, at: Column) -> Column:
            return let(near(at, _LARGE), lambda some: F.array_join(
                F.transform(cut(part, _BLOCK), lambda small, k: block(small, at + k * _BLOCK, some)), ""))

        return F.array_join(F.transform(cut(text, _LARGE), lambda part, j: large(part, j * _LARGE)), "")

    return F.when(F.size(spans) > 0, let(stretches(spans), whole)).otherwise(text)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets masked in the text and n_chars brought up to date; a null text stays null."""
    name = free_names(docs, "spans")[0]
    found = with_secrets(docs, name)
    found = found.withColumn("text", redacted(F.col("text"), F.col(name))).drop(name)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else found


def oracle_sql() -> str:
    """The same scan in SQL: places from the parts between matches, entropies window by window from the start."""
    q = lambda p: p.replace("'", "''")

    def spans(kind: int, pattern: str, keep: str = "true") -> str:
        return f"""
  SELECT rid, {kind} AS kind, start, start + lens[i] AS "end", m[i] AS found FROM (
    SELECT rid, m, i, lens, {keep} AS kept,
           list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(lens[1:i - 1]), 0) AS start
    FROM (SELECT rid, m, v, string_split_regex(text, '{q(pattern)}') AS gaps, list_transform(m, lambda x: length(x)) AS lens,
                 unnest(generate_series(1, len(m))) AS i
          FROM (SELECT rid, text, regexp_extract_all(text, '{q(pattern)}', 0) AS m, regexp_extract_all(text, '{q(pattern)}', {2 if kind == 1 else 0}) AS v
                FROM docs)))
  WHERE kept"""

    w = WINDOW
    label = "list_transform(s, lambda x: ['" + "', '".join(KINDS) + "'][x.kind] || ':' || x.start || ':' || x.\"end\")"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
base AS ({spans(1, ASSIGN, "length(v[i]) >= 6")}
UNION ALL {spans(2, ACCESS, "lens[i] >= 20")}
UNION ALL {spans(3, HEX, "lens[i] >= 24")}),
candidates AS ({spans(4, "[A-Za-z0-9+/_=-]{20,}")}),
cut AS (
  SELECT rid, start AS base, string_split_regex(found, '{ALLOWED}') AS gaps,
         list_transform(regexp_extract_all(found, '{ALLOWED}', 0), lambda x: length(x)) AS lens FROM candidates),
pieces AS (
  SELECT rid, gaps[i] AS found, base + coalesce(list_sum(list_transform(gaps[1:i - 1], lambda g: length(g))), 0) + coalesce(list_sum(lens[1:i - 1]), 0) AS start
  FROM (SELECT *, unnest(generate_series(1, len(gaps))) AS i FROM cut) WHERE length(gaps[i]) >= {w}),
whole_pieces AS (
  SELECT *, regexp_matches(found, '[0-9]') AND regexp_matches(found, '[a-z]') AND regexp_matches(found, '[A-Z]') AS mixed FROM pieces),
runs AS (
  SELECT rid, m[i] AS found, start + list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT rid, start, m, gaps, unnest(generate_series(1, len(m))) AS i
        FROM (SELECT rid, start, regexp_extract_all(found, '{RUN}', 0) AS m, string_split_regex(found, '{RUN}') AS gaps FROM whole_pieces WHERE NOT mixed))),
classed AS (
  SELECT rid, start, found, {MIXED[1]} AS bits FROM whole_pieces WHERE mixed
  UNION ALL
  SELECT rid, start, found,
         CASE WHEN regexp_full_match(found, '[0-9A-Fa-f]+') AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Fa-f]') THEN {RUNS[0][1]}
              WHEN regexp_full_match(found, '[a-z0-9]+') AND regexp_matches(found, '[0-9][a-z]+[0-9]') THEN {RUNS[1][1]}
              WHEN regexp_full_match(found, '[A-Z0-9]+') AND regexp_matches(found, '[0-9][A-Z]+[0-9]') THEN {RUNS[2][1]} END AS bits
  FROM runs),
high AS (
  SELECT *, list_filter(range(0, length(found) - {w} + 1),
                        lambda i: list_aggregate(string_split(substr(found, i + 1, {w}), ''), 'entropy') >= bits - 1e-9) AS found_at
  FROM classed WHERE bits IS NOT NULL),
entropy AS (SELECT rid, 4 AS kind, start + found_at[1] AS start, start + found_at[-1] + {w} AS "end" FROM high WHERE len(found_at) > 0),
every AS (
  SELECT rid, kind, start, "end" FROM base
  UNION ALL SELECT rid, kind, start, "end" FROM entropy e
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = e.rid AND b.start <= e.start AND e."end" <= b."end")),
lists AS (SELECT rid, list({{'kind': kind, 'start': start::BIGINT, 'end': "end"::BIGINT}} ORDER BY start, kind) AS s FROM every GROUP BY rid),
whole AS (SELECT doc_id, coalesce(s, []) AS s, list_filter(coalesce(s, []), lambda x: x.kind <= 3) AS b FROM docs LEFT JOIN lists USING (rid))
SELECT doc_id, {", ".join(f"len(list_filter(s, lambda x: x.kind = {i + 1})) AS n_{k}" for i, k in enumerate(KINDS))},
       sha256(array_to_string({label.replace("(s,", "(b,")}, ',')) AS base_sha256, array_to_string({label}, ',') AS spans
FROM whole"""
