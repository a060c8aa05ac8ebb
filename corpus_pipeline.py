"""From raw documents to packed training sequences: five stages, each on all that its predecessor kept."""

from pyspark.sql import functions as F

from kinora.llm import packing, pii, quality, setjoin, toxicity
from kinora.llm.common import read, stored
from kinora.llm.queries import TOXIC_FROM, vocabulary


def quality_rules(spark, docs, sf_dir):
    """Documents that pass the base and the proven cutoffs of their language."""
    return quality.kept_rows(docs, read(spark, sf_dir, "labels"))


def toxic_documents(spark, docs, sf_dir):
    """Documents that score below the toxicity cutoff, learnt from the labels outside the held-out fold."""
    labels = read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out()))
    return toxicity.filtered(docs, model, TOXIC_FROM)


def near_duplicates(spark, docs, sf_dir):
    """The document of the smallest id of each group that shares four fifths of its five-word shingles."""
    return setjoin.first_of_group(docs)


def personal_data(spark, docs, sf_dir):
    """Documents with personal data and the terms that give it away replaced."""
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark, docs, sf_dir):
    """Pieces of documents in sequences of at most 2,048 ids."""
    pieces = packing.pack(docs, vocabulary("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", quality_rules),
    ("toxicity", toxic_documents),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: The toxicity model, the similarity groups and the token ids have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
