"""License notices: word k-grams joined to template positions, votes by offset diagonal, neighbouring diagonals merged and verified."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 3
SLACK = 3
COVERAGE = 0.75

# The phrases that are base labels, and the opening words of public license notices.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
NOTICES = [
    ("all-rights-reserved", "all rights reserved"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl-3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
# End of fixed values.

Template = tuple[str, bool, str]
TEMPLATES: list[Template] = [(label, True, text) for label, text in BASE] + [(label, False, text) for label, text in NOTICES]


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of letters, digits and non-ASCII characters of the text with A-Z in lower case; a null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _template_grams(spark, templates: list[Template]) -> DataFrame:
    """One row per template position, and one with key 0 that the row each document has for itself meets."""
    rows = []
    for number, (label, base, text) in enumerate(templates):
        w = text.split()
        if len(w) < K:
            raise ValueError(f"a template has {K} words or more: {text}")
        rows += [(number, label, base, len(w), i, *w[i:i + K]) for i in range(len(w) - K + 1)]
    schema = "template int, label string, base boolean, size int, at int, t0 string, t1 string, t2 string"
    grams = spark.createDataFrame(rows, schema).withColumn("_key", F.xxhash64("t0", "t1", "t2"))
    own = spark.createDataFrame([(-1, None, False, 0, 0, "", "", "", 0)], f"{schema}, _key long")
    return grams.unionByName(own)


def votes(docs: DataFrame, templates: list[Template], id_column: str, text: str) -> DataFrame:
    """Per row, template and diagonal (word of the document minus word of the template) the template positions that
    agree; template -1 stands for the document itself. Every row has a number of its own, so rows that share an id are told apart.

    Every k-gram of a document is joined by its hash to the template positions, a table as long as the templates, and its words are
    compared. The rows of one diagonal are combined where they are read, before any shuffle.
    """
    own = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), words(F.col(text)).alias("w"))
    zipped = F.arrays_zip(F.col("w").alias("w0"), F.slice("w", 2, F.greatest(F.size("w"), F.lit(1))).alias("w1"),
                          F.slice("w", 3, F.greatest(F.size("w"), F.lit(1))).alias("w2"))
    each = own.select("row", "doc_id", F.size("w").cast("long").alias("n_words"), F.posexplode_outer(zipped).alias("pos", "gram"))
    key = F.when(F.col("gram.w1").isNull(), F.lit(0)).when(F.col("gram.w2").isNotNull(), F.xxhash64("gram.w0", "gram.w1", "gram.w2"))
    each = each.select("row", "doc_id", "n_words", "pos", key.alias("_key"), F.col("gram.w0").alias("g0"), F.col("gram.w1").alias("g1"), F.col("gram.w2").alias("g2"))
    same = (F.col("template") == -1) | ((F.col("g0") == F.col("t0")) & (F.col("g1") == F.col("t1")) & (F.col("g2") == F.col("t2")))
    hits = each.join(F.broadcast(_template_grams(docs.sparkSession, templates)), "_key").where(same)
    diagonal = F.when(F.col("template") >= 0, F.col("pos") - F.col("at")).otherwise(0).cast("long")
    return hits.groupBy("row", "template", diagonal.alias("diagonal")).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.first("label").alias("label"), F.first("base").alias("base"),
        F.first("size").alias("size"), F.collect_set("at").alias("votes"))


def find_notices(docs: DataFrame, templates: list[Template] = TEMPLATES, id_column: str = "doc_id", text: str = "text", slack: int = SLACK) -> DataFrame:
    """Regions of documents that follow a template: neighbouring diagonals, at most ``slack`` apart (words put in or
    left out), are one region. ``coverage`` is the share of the template's words under an agreeing k-gram, ``places`` the number of
    diagonals with every k-gram, ``first_place`` and ``last_place`` their words in the document. ``row`` numbers the rows of the
    table; the rows of template -1 stand for documents.
    """
    by_diagonal = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by_diagonal) > slack).cast("long"), F.lit(0))
    numbered = votes(docs, templates, id_column, text).withColumn("apart", apart)
    numbered = numbered.withColumn("region", F.sum("apart").over(by_diagonal.rowsBetween(Window.unboundedPreceding, 0)))
    whole = (F.col("template") >= 0) & (F.size("votes") == F.col("size") - (K - 1))
    regions = numbered.groupBy("row", "template", "region").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.first("label").alias("label"), F.first("base").alias("base"),
        F.first("size").alias("size"), F.array_distinct(F.flatten(F.collect_list("votes"))).alias("votes"), F.count_if(whole).alias("places"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_place"), F.max(F.when(whole, F.col("diagonal"))).alias("last_place"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("votes", lambda at: F.array(*[at + i for i in range(K)])))))
    return regions.withColumn("coverage", F.when(F.col("template") >= 0, covered / F.col("size")).otherwise(0.0))


def scan_licenses(docs: DataFrame, templates: list[Template] = TEMPLATES, id_column: str = "doc_id", text: str = "text",
                  slack: int = SLACK, min_coverage: float = COVERAGE) -> DataFrame:
    """One row per row of the table: its id, ``n_words``, the places of base phrases (``n_base``, ``first_word``, ``last_word``,
    ``base_labels``), ``labels`` (also of templates covered to ``min_coverage``) and ``score``, the best coverage.

    A base label needs all its words in a row. Texts without words give zeros, nulls and empty labels. Rows that share an id, or have none,
    are read each for itself. Templates may be of any length; other columns are not read.
    """
    regions = find_notices(docs, templates, id_column, text, slack)
    base = F.col("base") & (F.col("places") > 0)
    found = F.when(F.col("base"), F.col("places") > 0).otherwise(F.col("coverage") >= min_coverage)
    joined = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    return regions.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.sum(F.when(base, F.col("places")).otherwise(0)).alias("n_base"),
        F.min(F.when(base, F.col("first_place"))).alias("first_word"), F.max(F.when(base, F.col("last_place"))).alias("last_word"),
        joined(base).alias("base_labels"), joined(found).alias("labels"), F.max("coverage").alias("score")).drop("row")


def op3_license_diagonals(spark, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = f"""
with templates as (select t.*, string_split(words, ' ') as tw from (values
{','.join(f"({i}, '{label}', {str(base).lower()}, '{text}')" for i, (label, base, text) in enumerate(TEMPLATES))}) t(template, label, base, words)),
grams as (select template, label, base, len(tw) as size, i as pos, tw[i + 1] as g0, tw[i + 2] as g1, tw[i + 3] as g2
          from (select *, unnest(range(len(tw) - 2)) as i from templates)),
d as (select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+'), lambda x: x <> '') as w from documents),
each as (select r, i, w[i + 1] as g0, w[i + 2] as g1, w[i + 3] as g2 from (select *, unnest(range(len(w) - 2)) as i from d)),
votes as (select r, template, any_value(label) as label, any_value(base) as base, any_value(size) as size, i - pos as diagonal,
                 bit_or(1::bigint << pos::bigint) as votes
          from each join grams using (g0, g1, g2) group by r, template, i - pos),
marked as (select *, coalesce((diagonal - lag(diagonal) over (partition by r, template order by diagonal) > {SLACK})::int, 0) as apart from votes),
numbered as (select *, sum(apart) over (partition by r, template order by diagonal) as region, votes = (1::bigint << (size - 2)) - 1 as whole from marked),
regions as (select r, template, any_value(label) as label, any_value(base) as base, any_value(size) as size, bit_or(votes) as votes,
                   count(*) filter (whole) as places, min(diagonal) filter (whole) as lo, max(diagonal) filter (whole) as hi
            from numbered group by r, template, region),
scored as (select *, bit_count(votes | (votes << 1) | (votes << 2)) / size as coverage, base and places > 0 as is_base from regions),
found as (select r, sum(places) filter (is_base) as n_base, min(lo) filter (is_base) as lo, max(hi) filter (is_base) as hi,
                 array_to_string(list_sort(list_distinct(list(label) filter (is_base))), ',') as base_labels,
                 array_to_string(list_sort(list_distinct(list(label) filter (case when base then places > 0 else coverage >= {COVERAGE} end))), ',') as labels,
                 max(coverage) as score from scored group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, lo::bigint as first_word, hi::bigint as last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from d left join found using (r)"""
