"""A corpus from `documents` to token ids, in five stages.

Each stage reads what its predecessor wrote. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from remitwise.llm import language, mixing, neardup, pieces, surrogates
from remitwise.llm.common import land, pick, table
from remitwise.llm.queries import tokenizer

# Percent of common shingles from which two documents are near-duplicates here.
SIMILAR = 80
# The secret of the surrogates here; a corpus that leaves the house needs its own.
TEST_KEY = b"corpus test key"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# No statement: pivotal draws, keyed surrogates and subword ids are outside SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents in no language: null texts and texts without a letter."""
    learned = pick(docs, "doc_id", "text", "lang").filter(f"not {language.HELD_OUT}")
    judged = language.predict(docs, language.learn(learned), carry=COLUMNS)
    return judged.filter(f"lang_pred <> '{language.UNKNOWN}'").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.deduplicated(pick(docs, *COLUMNS), SIMILAR)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates; `n_chars` follows the new text."""
    done = surrogates.pseudonymised(docs, TEST_KEY, carry=("lang", "source", "n_chars"))
    return done.selectExpr("doc_id", "text", "lang", "source",
                           "if(n_entities > 0, cast(length(text) as bigint), n_chars) as n_chars")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(pick(docs, *COLUMNS))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every row."""
    return pieces.digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates),
          ("personal_data", replace_personal_data), ("mixing", mix_sources),
          ("sentencepiece", encode_pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with a written table between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
