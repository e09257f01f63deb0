"""From raw documents to packed training sequences, stage by stage.

Each stage works on all that its predecessor kept. Stages 1 to 3 return the rows of ``documents`` that stay, stage 4 the rows of the
mixture, a row per pass over a document; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketflow.llm import chunks, mixing, packing, similar, tokens, toxicity
from marketflow.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below 0.5; the model learns from labelled rows whose crc32 remainder by 5 is not 0."""
    prepare(spark)
    raw = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(raw, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    prepare(spark)
    return chunks.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: by fingerprints and their balls, as op10 links them; then, of the rows that are left,
    by five-word shingles and a similarity of 0.8 or more, which finds what fingerprints miss."""
    prepare(spark)
    return similar.deduplicated(stored(similar.deduplicated_by_fingerprint(docs), "by_fingerprint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per pass over a document; every document has one at least."""
    prepare(spark)
    return mixing.mixture(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids. Fewer pieces are remembered, as the memory of the stages before is still held."""
    prepare(spark)
    return packing.packed(docs, tokens.default_path(), kept=250_000)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies), ("mixing", mix_sources),
          ("packing", pack_sequences)]

#: A trained model and a tokenizer stand behind the rows: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written to the shared folder and read back."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "_"))
    return docs
