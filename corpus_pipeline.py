"""The corpus pipeline: documents in, packed sequences out.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read again as the
next one's docs. All but the last return the columns that they were given. Columns that are none of documents' go through
them unread; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import jaccard, langid, mixing, packing, toxicity
from marlstone.llm._shared import scratch, table
from marlstone.llm.queries import language_model, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the table of labels, finds toxic go. A null or empty text has the score
    of the bias alone; a score of 0.5 is toxic; repeated rows are decided alike, each for itself."""
    return toxicity.score(docs, toxicity_model(spark, sf_dir)).where("predicted = 0").select(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not determined, or is far from all that were learned, go: among them those with a
    null text or no letter. Of equally near languages the first by name counts; repeated rows are decided alike. lang
    is never read of the documents that are judged, only of those learned from, where a null teaches nothing."""
    return langid.identify(docs, language_model(spark, sf_dir)).where("not rejected").select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose word shingles are alike, with all they are linked to, the one with the least id stays, of
    equal ids that with the least hash of its text, and one row of those equal in both; a null id comes last. Documents
    without words (null, empty, white space) are like no other and all stay."""
    return jaccard.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. A null text has no words; a null source is one of its own, the last;
    documents that share an id are taken alike."""
    return mixing.emit(mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document and their places in sequences. A text without words (null, empty) has one piece of
    length 0 in no sequence; one longer than the longest sequence is cut; repeated rows are packed each for itself."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("jaccard_join", keep_one_of_each_class),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Two of the stages decide by trained models: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch() as keep:  # what a stage has written for itself goes once its result is there
            docs = keep(stage(spark, docs, sf_dir), name)
    return docs
