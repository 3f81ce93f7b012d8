"""A training corpus from raw documents: toxicity, near duplicates, benchmark leaks, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next.
All but the last return the columns of documents. Toxic and leaked documents are dropped where they are read; near
copies are dropped by a number that each stored row gets, so repeated and null doc_ids change nothing.

Defined results, for every stage: null and empty texts are kept, and packed as their end id; very long texts are read whole; repeated rows are rows of their
own, of which the second stage keeps one where they have words; an empty table gives an empty table; extra columns come through unchanged, whatever
their names, as rows travel as one struct wherever a stage adds columns of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestlake.llm import decontaminate, jaccard, packing, secrets, toxicity
from digestlake.llm.shared import join_hot, stored, text_or_empty, whole_texts


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the network trained on the labels does not call toxic."""
    network, share = toxicity.fit(docs, whole_texts(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, network, share)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.8 or more over five words, the row of the least doc_id stays, nulls last, and of equal ones the first stored.

    Documents without words are linked with nothing and stay.
    """
    whole_texts(spark)
    # the numbers are written, since they would differ where rows are read again
    rows = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")), "rows")
    groups = stored(jaccard.cluster(rows, jaccard.Join(n=5, percent=80), id_col="row", text_col="doc.text").select(F.col("id").alias("gone"), F.col("component_id").alias("group")), "groups")
    several = groups.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = join_hot(groups, several, "group", ["gone"], rows.count(), "inner")
    named = stored(members.join(rows.select(F.col("row").alias("gone"), "doc.doc_id").hint("merge"), "gone"), "members")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("gone").alias("row"))
    # a group's stayer is its least place, which is aggregated before the shuffle; all other rows go
    stays = named.groupBy("group").agg(F.min(place).alias("least")).select(F.col("least.row").alias("gone"))
    gone = named.select("gone").hint("merge").join(stays, "gone", "left_anti").withColumnRenamed("gone", "row")
    # both sides grow with the corpus, so the join is by sort and merge at every size
    return rows.hint("merge").join(gone, "row", "left_anti").select("doc.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that contain no benchmark item."""
    return decontaminate.clean(docs, whole_texts(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


#: What replaces a secret.
MASK = "[secret]"


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets of every kind masked and n_chars counted anew where something was masked.

    Where spans overlap, their union is masked once. A null text stays null.
    """
    whole_texts(spark)
    found, total = secrets.spans_of(docs, secrets.Ledger(spark), secrets.RULES + secrets.MORE_RULES)
    # spans come by start: each gives the text between the furthest end so far and itself, and then the mask
    cut = F.expr(
        f"""aggregate(spans, named_struct('at', 0L, 'out', ''), (a, s) -> if(s.end <= a.at, a,
            named_struct('at', s.end, 'out', concat(a.out, if(s.start < a.at, '', concat(substr(doc.text, cast(a.at as int) + 1, cast(s.start - a.at as int)), '{MASK}'))))),
            a -> concat(a.out, substr(doc.text, cast(a.at as int) + 1)))"""
    )
    keyed = docs.select(F.struct("*").alias("doc"), secrets.blob_of(text_or_empty("text")).alias("blob"))
    joined = join_hot(keyed, found, "blob", ["doc.doc_id"], total)
    text = F.when(F.col("spans").isNotNull(), cut).otherwise(F.col("doc.text"))
    masked = joined.select("doc", F.col("spans").isNotNull().alias("changed"), text.alias("text"))
    n_chars = F.when(F.col("changed"), F.length("text").cast("long")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None
    new = {"text": F.col("text"), "n_chars": n_chars}
    return masked.select(*[new[c].alias(c) if c in new else F.col("doc").getField(c).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens. Workers go on to other stages, so they keep no words."""
    whole_texts(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, keep_words=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The network, the tokenizer and the search are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name)
    return docs
