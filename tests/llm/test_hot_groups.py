"""Repeated rows, null ids and repeated ids in numbers: no row is lost, no task gets them all."""

from statistics import median

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from lapsewise.llm import language, order_minhash, packing, simhash, substring

SCHEMA = "doc_id long, text string"


def table(spark, rows, parts=8):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def kept(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)


def test_a_repeated_id_with_another_text_is_not_lost(spark):
    copies, other = "a b c d e f", "something wholly different in here now"
    rows = [(1, copies), (2, copies), (2, other)]
    assert kept(simhash.keep_one(table(spark, rows))) == sorted([(1, copies), (2, other)], key=repr)
    # the text hash decides between two rows of one id in one group, whichever comes first
    near = [(3, "x y z x y z x y z"), (3, "x y z x y z x y z")]
    assert kept(simhash.keep_one(table(spark, near))) == [near[0]]


def test_rows_without_an_id_stand_behind_those_that_have_one(spark):
    text, own = "one two three four five six", "a row that nobody else has at all"
    assert kept(simhash.keep_one(table(spark, [(None, text), (None, text), (None, own)]))) == sorted([(None, own), (None, text)], key=repr)
    assert kept(simhash.keep_one(table(spark, [(None, text), (9, text), (None, "")]))) == sorted([(9, text), (None, "")], key=repr)


def test_one_of_thousands_of_equal_rows_stays(spark):
    rows = [(5, "the same again and again")] * 3000 + [(i, f"text number {i} of its own kind {i * i}") for i in range(10, 20)]
    found = kept(simhash.keep_one(table(spark, rows)))
    assert len(found) == 11 and found.count((5, "the same again and again")) == 1


def equal_rows(spark, n=20_000):
    words = " ".join(f"w{i}" for i in range(60))
    return spark.range(0, n, 1, 8).select(F.lit(7).cast("long").alias("doc_id"), F.lit(words).alias("text"))


def test_equal_rows_are_spread_over_shards(spark):
    dealt = substring.in_shards(equal_rows(spark), 16).groupBy("shard").count().collect()
    assert len(dealt) >= 4 and max(r["count"] for r in dealt) <= 20_000 / 2
    smaller = table(spark, [(1, equal_rows(spark, 1).first()["text"])])
    cut = substring.repeats(equal_rows(spark, 400).unionByName(smaller), shard_bytes=4000)
    assert {(r["doc_id"], r["cut"]["n_removed"]) for r in cut.collect()} == {(7, 60), (1, 0)}


def test_parts_follow_the_text(spark):
    """A part of the hash range gets no more hashes than it may, at any size."""
    for text_bytes in (10**6, 10**9, 30 * 10**9, 10**14):
        shards, bits = substring.sizes(text_bytes, 200)
        assert text_bytes / 2 / (1 << bits) <= substring.PART_HASHES and text_bytes / shards <= substring.SHARD_BYTES
    assert substring.sizes(10**6, 200)[1] == 8 < substring.sizes(30 * 10**9, 200)[1]
    docs = table(spark, [(i, " ".join(f"w{j % 90}" for j in range(i, i + 80))) for i in range(20)])
    few, many = (sorted((r["doc_id"], r["cut"]["n_removed"]) for r in substring.repeats(docs, part_hashes=n).collect()) for n in (50, 10**6))
    assert few == many


def test_equal_pieces_are_spread_over_groups(spark):
    docs = equal_rows(spark).withColumn("text", F.lit("a few words only"))
    found = packing.packed(docs, path("byte_bpe_50k.json"), group_windows=8).select("length", (F.shiftright("sequence_id", packing.GROUP_SHIFT)).alias("group"))
    sizes = [r["count"] for r in found.groupBy("group").count().collect()]
    assert sum(sizes) == 20_000 and len(sizes) >= 8
    assert max(sizes) <= 1.5 * median(sizes)


def test_a_third_without_an_id_is_spread_over_ranges(spark):
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    ranges = order_minhash.in_ranges(rows, 50).filter("not guest").groupBy("bucket").count().collect()
    sizes = [r["count"] for r in ranges]
    assert sum(sizes) == 30_000 and 50 <= len(sizes) <= 51
    assert max(sizes) <= 3 * median(sizes)


def test_equal_documents_follow_each_other(spark):
    """Also where a range ends among them: each is the next of another, and the last has the next one's text."""
    rows = [(5, "same words here now")] * 200 + [(4, "the one after them all")]
    found = order_minhash.edited_and_next(table(spark, rows), 12).collect()
    assert len(found) == 201
    assert sorted(r["near_next"] for r in found if r["doc_id"] == 5)[1:] == [1.0] * 199
    assert len({r["fingerprint"] for r in found}) == 2


def test_the_smallest_id_is_an_id(spark):
    least = -(1 << 63)
    found = order_minhash.edited_and_next(table(spark, [(least, "a b c"), (None, "d e f"), ((1 << 63) - 1, "g h i")])).collect()
    assert {r["doc_id"] for r in found} == {least, None, (1 << 63) - 1}


def test_the_language_sample_holds_whatever_the_ids(spark):
    rows = spark.range(0, 9000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, F.lit(1)).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 1, F.lit("always the same text")).otherwise(F.concat(F.lit("text number "), F.col("id"))).alias("text"),
        F.lit("en").alias("lang"),
    )
    drawn = language.sample(rows, 400).collect()
    assert 250 < len(drawn) < 550 and sum(r["text"] == "always the same text" for r in drawn) <= 1


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rows = spark.createDataFrame([(i, "a text", f"l{i % 4}") for i in range(40)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="4 languages"):
        language.fit(rows)
    assert language.fit(rows.filter("lang <> 'l3'")) is not None
