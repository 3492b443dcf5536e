"""The registered queries: thin readers of whole tables around the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, embeddings, langid, minhash, quality, toxicity, urlfilter, warc
from .common import checkpointed, learns, read
from .sql import ORACLES

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judged(read(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "rule", "verdict")


def linking(pages: DataFrame) -> DataFrame:
    """The pages, two of three with a canonical link or a refresh to the page after them."""
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("to")).where("page_id is not null")
    tag = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit('<link href="'), F.replace("to", F.lit("&"), F.lit("&amp;")), F.lit('" rel="canonical">')))
    tag = tag.when(F.col("page_id") % 3 == 2, F.concat(F.lit('<META content="0; URL='), "to", F.lit('" http-equiv="refresh">')))
    return pages.join(after, "page_id", "left").select("page_id", "url", F.concat(F.coalesce("html", F.lit("")), F.coalesce(tag, F.lit(""))).alias("html"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The url filter where there are links: the table's own pages hold none."""
    return urlfilter.judged(linking(read(spark, sf_dir, "pages")), RULES).select("page_id", "host", "path", "rule", "verdict", (F.col("component").isNotNull()).alias("aliased"))


def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.scratch_folder(spark, "warc")
    warc.write_archives(warc.captures_of(read(spark, sf_dir, "pages")), folder)
    index = checkpointed(warc.merged_index(warc.read_archives(spark, folder)))
    warc.drop_folder(spark, folder)
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = learns("doc_id", 5) == 0
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), ~held)
    return toxicity.scored(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = learns("doc_id", 4) == 2
    return langid.identify(docs, ~held, ["doc_id"]).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(read(spark, sf_dir, "documents").select("doc_id", "text"), ids=False)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held = learns("doc_id", 5) == 0
    model = quality.train(docs, read(spark, sf_dir, "labels"), ~held)
    return quality.scored(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), k=4, percent=80)


def op9_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.linked(read(spark, sf_dir, "conversations"))


def quoting(conversations: DataFrame) -> DataFrame:
    """The conversations with replies that quote: the turn before, two levels of turns, or the next conversation's opening.

    Every kind of reply is joined to the turns that it quotes only; a turn before is quoted by another kind of reply, so no text travels in vain.
    """
    rows = conversations.select("conv_id", "turn", "role", F.col("text").cast("string").alias("text")).withColumn("kind", F.coalesce(F.col("turn") % 4, F.lit(0)))
    said = rows.where("conv_id is not null and kind in (0, 1)").groupBy("conv_id", "turn").agg(F.min("text").alias("said"))
    before = lambda n, name: said.select("conv_id", (F.col("turn") + n).alias("turn"), F.col("said").alias(name))
    opening = rows.where("turn = 0 and conv_id is not null").groupBy("conv_id").agg(F.min("text").alias("said")).select((F.col("conv_id") - 1).alias("conv_id"), F.substring_index("said", "\n", 1).alias("o"))
    text = F.coalesce("text", F.lit(""))
    marked = lambda name, first, other: F.concat(F.lit(first), F.replace(F.col(name), F.lit("\n"), F.lit("\n" + other)), F.lit("\n"))
    first = rows.where("kind = 1").join(before(1, "a").where("turn % 4 = 1"), ["conv_id", "turn"], "left").withColumn("made", F.concat(marked("a", "> ", "> "), text))
    second = rows.where("kind = 2").join(before(1, "a").where("turn % 4 = 2"), ["conv_id", "turn"], "left").join(before(2, "b").where("turn % 4 = 2"), ["conv_id", "turn"], "left")
    second = second.withColumn("made", F.concat(marked("b", ">> ", "> > "), marked("a", ">", "> "), text))
    third = rows.where("kind = 3").join(opening, "conv_id", "left").withColumn("made", F.concat(text, F.lit("\n> "), F.col("o"), F.lit("\nso I read")))
    rest = rows.where("kind not in (1, 2, 3)").withColumn("made", F.col("text"))
    out = [part.select("conv_id", "turn", "role", F.coalesce("made", "text").alias("text")) for part in (rest, first, second, third)]
    return checkpointed(out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3]))


def quoted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotation linking where there are quotations: the table's own messages hold none."""
    return chat.linked(quoting(read(spark, sf_dir, "conversations")))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_url_filter, op2_warc_index, op3_toxicity, op4_language, op5_bpe, op6_quality, op7_decontamination, op8_minhash, op9_quotations, op10_embeddings, linked_pages, quoted_conversations]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
