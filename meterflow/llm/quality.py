"""Quality rules whose cutoffs come from the corpus: mergeable quantile sketches per language and source, and a joined filter."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .store import step

SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_ROWS = 200
FENCE = 3
SALTS = 16
SUB_BUCKETS = 64


@dataclass(frozen=True)
class Measure:
    """A whole number of each document that should lie between two fences.

    The upper fence is Q3 + ``FENCE`` * spread and the lower one, where ``low`` asks for it, Q1 - ``FENCE`` * spread; the spread is
    Q3 - Q1, and ``floor`` where the quartiles are closer than that (of most corpora half the documents hold no symbol at all).
    """

    name: str
    floor: int
    low: bool = False


MEASURES = [
    Measure("word_length", 50, low=True),   # hundredths of a code point a word
    Measure("symbols", 50),                 # per 1000 words
    Measure("dup_lines", 150),              # per 1000 lines with a word
    Measure("repeats", 100),                # words in repeated windows, per 1000 words
]


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _repeat_words(w: Column) -> Column:
    """Words in windows of three that occur twice or more among the words ``w`` of one text.

    The windows' hashes are sorted with their places, so copies are neighbours; the places of those that have one are
    put in order again and their windows laid over one another.
    """
    n = F.size(w)
    windows = F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def places(p: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

    covered = lambda q: F.aggregate(
        q, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct((x + 3).alias("end"), (a["n"] + x + 3 - F.greatest(a["end"], x)).alias("n")), lambda a: a["n"])
    return _let(windows, lambda p: covered(places(p)))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``m``, a struct of whole numbers for every row: ``n_words`` (words ``[^\\x20\\x09-\\x0D]+``), ``word_chars`` (their code points),
    ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines`` (those equal to an earlier one) and ``n_repeat_words``.
    Built-in functions only, one row at a time; a null text counts as an empty one."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda x: x != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    long = lambda c: c.cast("long")
    word_counts = _let(words, lambda w: F.struct(long(F.size(w)).alias("n"), long(_repeat_words(w)).alias("again")))
    line_counts = _let(lines, lambda x: F.struct(long(F.size(x)).alias("n"), long(F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    counted = docs.withColumns({"_w": word_counts, "_l": line_counts})
    return counted.withColumn("m", F.struct(
        F.col("_w.n").alias("n_words"), long(F.length(F.translate(t, SPACES, ""))).alias("word_chars"),
        long(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"), F.col("_l.n").alias("n_lines"),
        F.col("_l.again").alias("n_dup_lines"), F.col("_w.again").alias("n_repeat_words"))).drop("_w", "_l")


def _values() -> Column:
    """The measures of a row, in the order of ``MEASURES``; null where there is nothing to divide by."""
    per = lambda x, scale, n: F.expr(f"if(m.{n} > 0, m.{x} * {scale} div m.{n}, null)")
    return F.array(per("word_chars", 100, "n_words"), per("n_symbols", 1000, "n_words"), per("n_dup_lines", 1000, "n_lines"),
                   per("n_repeat_words", 1000, "n_words"))


def _bucket(v: str) -> Column:
    """Log-linear bucket of a whole number: exact below 2 * ``SUB_BUCKETS``, then ``SUB_BUCKETS`` to each power of two."""
    shift = f"greatest(0, length(bin({v})) - {SUB_BUCKETS.bit_length()})"
    return F.expr(f"cast({SUB_BUCKETS} * {shift} + shiftright({v}, {shift}) as int)")


def _least_of(b: Column) -> Column:
    """The least number in a bucket; the bucket's width is 2 ** shift."""
    shift = F.greatest(F.lit(0), F.floor(b / SUB_BUCKETS).cast("int") - 1)
    return F.call_function("shiftleft", (b - shift * SUB_BUCKETS).cast("long"), shift)


def sketch(judged: DataFrame, keys: list[str]) -> DataFrame:
    """Quantile sketches: how many rows of each group have a measure in each bucket. Sketches merge by adding counts, so they are
    combined in every task before the shuffle, a hot group sends as few rows as any other, and no order or retry changes them."""
    each = judged.select(*keys, F.posexplode(_values()).alias("measure", "v")).where("v is not null")
    return each.groupBy(*keys, "measure", _bucket("v").alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """``q1``, ``q3`` (the least number in the bucket they fall into; within 1/64 of the quartile) and ``rows`` of each group and measure.

    A window holds the buckets of one sketch, at most a few hundred rows."""
    own = Window.partitionBy(*keys, "measure")
    so_far = F.sum("n").over(own.orderBy("bucket"))
    summed = sketches.withColumns({"_rows": F.sum("n").over(own), "_upto": so_far})
    at = lambda quarters: _least_of(F.min(F.when(F.col("_upto") * 4 >= F.col("_rows") * quarters, F.col("bucket"))))
    return summed.groupBy(*keys, "measure").agg(at(1).alias("q1"), at(3).alias("q3"), F.first("_rows").alias("rows"))


def thresholds(sketches: DataFrame, lang: str = "lang", source: str = "source", measures: list[Measure] = MEASURES,
               min_rows: int = MIN_ROWS, fence: int = FENCE) -> DataFrame:
    """Fences of every (language, source, measure): of its own sketch where that holds ``min_rows`` documents, else of its
    language's, merged from all sources, else of the whole corpus'. A null language or source is a group like any other."""
    own, by_lang, whole = quartiles(sketches, [lang, source]), quartiles(merged(sketches, [lang]), [lang]), quartiles(merged(sketches, []), [])
    as_level = lambda q, name: q.select(*[F.col(c).alias(f"_{name}_{c}") for c in q.columns])
    a, b = as_level(by_lang, "b"), as_level(whole, "c")
    joined = own.join(a, own[lang].eqNullSafe(F.col(f"_b_{lang}")) & (own["measure"] == F.col("_b_measure")))
    joined = joined.join(b, F.col("measure") == F.col("_c_measure"))
    pick = lambda c: F.when(F.col("rows") >= min_rows, F.col(c)).when(F.col("_b_rows") >= min_rows, F.col(f"_b_{c}")).otherwise(F.col(f"_c_{c}"))
    floors = F.element_at(F.array(*[F.lit(m.floor) for m in measures]), F.col("measure") + 1)
    lows = F.element_at(F.array(*[F.lit(m.low) for m in measures]), F.col("measure") + 1)
    chosen = joined.select(lang, source, "measure", pick("q1").alias("q1"), pick("q3").alias("q3"))
    spread = F.greatest(F.col("q3") - F.col("q1"), floors.cast("long"))
    return chosen.select(lang, source, "measure", F.when(lows, F.col("q1") - fence * spread).alias("low"), (F.col("q3") + fence * spread).alias("high"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, by default all), ``m`` (counts, see ``with_counts``), ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. The others give the sketches of their
    (language, source), and stay unless a measure lies outside their group's fences. One row for every input row, repeated rows
    too. Empty and null texts have no words and fail; a group all of whose documents fail has no sketch and needs none.
    Texts are read once: counts are written with the rows. Then the fences, one row per group,
    ``SALTS`` times over, meet them on (language, source, salt), so a source with a third of all rows is split.
    """
    chosen = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"), F.col(text).alias("_text"),
                         F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"))
    failed = (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > MAX_REPEAT_PCT * F.col("m.n_words"))
    held = step(with_counts(chosen, "_text").drop("_text").withColumn("base_failed", failed), "counts")
    sketches = step(sketch(held.where("not base_failed"), ["lang", "source"]), "sketches")
    fences = thresholds(sketches).groupBy("lang", "source").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("fences"))
    salted = fences.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fences", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    rows = held.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = rows.join(salted, rows["lang"].eqNullSafe(F.col("_lang")) & rows["source"].eqNullSafe(F.col("_source")) & (F.col("salt") == F.col("_salt")), "left")
    inside = lambda v, k: F.coalesce((v >= F.col("fences")[k]["low"]), F.lit(True)) & F.coalesce(v <= F.col("fences")[k]["high"], F.lit(True))
    kept = ~F.col("base_failed") & F.forall(F.transform(_values(), inside), lambda x: x)
    return joined.select("row", "m", "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns."""
    return judge(docs, text, lang, source).where("kept").select("row.*")


def op11_adaptive_thresholds(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    rows = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return rows.select("row.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "base_failed", "kept")


_LEAST = f"((bucket - {SUB_BUCKETS} * greatest(0, bucket // {SUB_BUCKETS} - 1)) << greatest(0, bucket // {SUB_BUCKETS} - 1))"


def _quartile_sql(keys: str, source: str) -> str:
    group = f"{keys}, " if keys else ""
    return f"""(select {group}measure, min(case when upto * 4 >= rows then least_of end) as q1, min(case when upto * 4 >= rows * 3 then least_of end) as q3, max(rows) as rows
        from (select *, {_LEAST} as least_of, sum(n) over (partition by {group}measure) as rows, sum(n) over (partition by {group}measure order by bucket) as upto
              from (select {group}measure, bucket, sum(n)::bigint as n from {source} group by {group}measure, bucket)) group by {group}measure)"""


_FLOORS = ", ".join(str(m.floor) for m in MEASURES)
_PICK = "case when o.rows >= {m} then o.{c} when l.rows >= {m} then l.{c} else w.{c} end"

ORACLE = f"""
with d as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
s as (select *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d),
grams as (select r, i, w[i + 1] as a, w[i + 2] as b, w[i + 3] as c from (select r, w, unnest(range(len(w) - 2)) as i from s)),
twins as (select r, i from (select *, count(*) over (partition by r, a, b, c) as n from grams) where n > 1),
again as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from twins) group by r),
m as (select s.r, doc_id, lang, source, len(w)::bigint as n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
             (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(again.n, 0)::bigint as n_repeat_words from s left join again using (r)),
j as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words as base_failed,
             [case when n_words > 0 then word_chars * 100 // n_words end, case when n_words > 0 then n_symbols * 1000 // n_words end,
              case when n_lines > 0 then n_dup_lines * 1000 // n_lines end, case when n_words > 0 then n_repeat_words * 1000 // n_words end] as v from m),
each as (select r, lang, source, base_failed, unnest(v) as v, unnest(range(4)) as measure from j),
shifted as (select *, greatest(0, length(bin(v)) - {SUB_BUCKETS.bit_length()}) as sh from each where v is not null),
sk as (select lang, source, measure, {SUB_BUCKETS} * sh + (v >> sh) as bucket, count(*) as n from shifted where not base_failed group by all),
fences as (select lang, source, measure, case when measure = 0 then q1 - {FENCE} * spread end as low, q3 + {FENCE} * spread as high
           from (select *, greatest(q3 - q1, [{_FLOORS}][measure + 1]) as spread from
             (select o.lang, o.source, o.measure, {_PICK.format(m=MIN_ROWS, c='q1')} as q1, {_PICK.format(m=MIN_ROWS, c='q3')} as q3
              from {_quartile_sql('lang, source', 'sk')} o join {_quartile_sql('lang', 'sk')} l on l.lang is not distinct from o.lang and l.measure = o.measure
              join {_quartile_sql('', 'sk')} w on w.measure = o.measure))),
bad as (select distinct r from each e join fences f on f.lang is not distinct from e.lang and f.source is not distinct from e.source and f.measure = e.measure
        where v < low or v > high)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and r not in (select r from bad) as kept from j"""
