"""License scan with a positional index of rare licence words.

All words of a text that occur in a licence template are kept with their positions. Document
frequencies over the whole corpus name the rarest key word of each template (its anchor). In texts that
hold an anchor, each word's position minus its position in the template gives the
place where the template would start; postings that agree on it are counted, and a licence is found where all
words of its key phrase stand at their places.

Defined results: null and empty texts have no words and no labels; rows that repeat a doc_id are scanned
each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagauge.llm.common import stage, table

# Label, notice, key phrase that must stand in a text word by word.
TEMPLATES = (
    ("mit", "released under the mit license", "under the mit license"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("reserved", "all rights reserved", "all rights reserved"),
)
BASE = ("mit", "apache-2", "cc-by-nc")
# What a word is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _postings() -> list[tuple[str, int, str, int, bool, int, int, int]]:
    """word, template number, label, position, in the key phrase, template length, key length, key start."""
    out = []
    for t, (label, notice, key) in enumerate(TEMPLATES):
        words, keys = notice.split(), key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(keys)] == keys)
        for i, word in enumerate(words):
            out.append((word, t, label, i, start <= i < start + len(keys), len(words), len(keys), start))
    return out


def licence_words(documents: DataFrame) -> DataFrame:
    """doc_id, row, n_words and `hits` (word, position) of template words; positions count from 0."""
    known = sorted({p[0] for p in _postings()})
    words = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), 0)
    held = documents.select("doc_id", words.alias("words"))
    at = F.transform("words", lambda w, i: F.when(w.isin(known), F.struct(w.alias("word"), i.alias("i"))))
    return held.select("doc_id", F.monotonically_increasing_id().alias("row"), F.size("words").cast("long").alias("n_words"), F.filter(at, lambda x: x.isNotNull()).alias("hits"))


def find(spark: SparkSession, held: DataFrame) -> DataFrame:
    """row, label, start, key_start, share: each place where a key phrase stands.

    share: how much of the whole notice stands there. The postings are a fixed list of a few dozen rows.
    """
    index = spark.createDataFrame(_postings(), "word string, t int, label string, pos int, is_key boolean, n int, n_key int, key_at int")
    seen = held.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    often = {r["word"]: r["count"] for r in seen.collect()}
    anchors = {min(key.split(), key=lambda w: (often.get(w, 0), w)) for _, _, key in TEMPLATES}
    near = held.where(F.arrays_overlap("hits.word", F.array(*map(F.lit, sorted(anchors)))))
    near = near.select("row", F.inline("hits"))
    met = near.join(F.broadcast(index), "word").groupBy("row", "t", "label", "n", "n_key", "key_at", (F.col("i") - F.col("pos")).alias("start"))
    met = met.agg(F.count("*").alias("words"), F.count_if("is_key").alias("keys")).where("keys = n_key")
    return met.select("row", "label", "start", (F.col("start") + F.col("key_at")).alias("key_start"), (F.col("words") / F.col("n")).alias("share"))


def scan(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document with the licences found and where the base phrases stand."""
    held = stage(spark, licence_words(documents), "licence-words")
    places = find(spark, held)
    base = F.col("label").isin(*BASE)
    joined = lambda c: F.concat_ws(",", F.sort_array(F.collect_set(c)))
    per = places.groupBy(F.col("row").alias("r")).agg(
        F.count_if(base).alias("n"), F.min(F.when(base, F.col("key_start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("key_start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("b"), joined("label").alias("l"), F.max("share").alias("s"),
    )
    return held.join(per, held["row"] == per["r"], "left").select(
        "doc_id", "n_words", F.coalesce("n", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("b", F.lit("")).alias("base_labels"), F.coalesce("l", F.lit("")).alias("labels"), F.coalesce("s", F.lit(0.0)).alias("score"),
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, table(spark, sf_dir, "documents"))


_ROWS = ", ".join(f"('{label}', string_split('{notice}', ' '), string_split('{key}', ' '))" for label, notice, key in TEMPLATES)

OP8_SQL = rf"""
WITH held AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
template(label, notice, phrase) AS (VALUES {_ROWS}),
placed AS (
  SELECT *, list_filter(range(len(notice)), lambda i: notice[i + 1 : i + len(phrase)] = phrase)[1] AS key_at FROM template),
place AS (
  SELECT doc_id, words, label, notice, key_at, unnest(list_filter(range(len(words)), lambda i: words[i + 1] = phrase[1] AND words[i + 1 : i + len(phrase)] = phrase)) AS key_start
  FROM held, placed),
scored AS (
  SELECT doc_id, label, key_start,
    len(list_filter(range(len(notice)), lambda j: key_start - key_at + j >= 0 AND words[key_start - key_at + j + 1] = notice[j + 1])) / len(notice) AS share
  FROM place),
per AS (
  SELECT doc_id, count(*) FILTER (label IN {BASE}) AS n, min(key_start) FILTER (label IN {BASE}) AS a, max(key_start) FILTER (label IN {BASE}) AS z,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (label IN {BASE}) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS l, max(share) AS s
  FROM scored GROUP BY doc_id)
SELECT h.doc_id, CAST(len(h.words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(a AS BIGINT) AS first_word, CAST(z AS BIGINT) AS last_word,
  coalesce(b, '') AS base_labels, coalesce(l, '') AS labels, coalesce(s, 0.0::DOUBLE) AS score
FROM held h LEFT JOIN per USING (doc_id)
"""
