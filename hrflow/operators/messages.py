"""Message validation, parsing and flagging."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import word_tokens
from ..schemas import MESSAGE

MESSAGE_FIELDS = ["sender", "receiver", "message"]

# J24 ------------------------------------------------------------------------------
def validate_messages(df: DataFrame) -> DataFrame:
    """Keep messages that have sender, receiver and text."""
    return df.filter(F.col("sender").isNotNull() & F.col("receiver").isNotNull() & F.col("message").isNotNull())


# J25 ------------------------------------------------------------------------------
def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Kafka bytes -> text -> struct -> columns. Malformed JSON gives NULL fields."""
    return raw.select(F.from_json(F.col(value).cast("string"), MESSAGE).alias("data")).select("data.*")


# J26 / J27 ------------------------------------------------------------------------
def normalized_words(words: DataFrame, column: str = "word") -> DataFrame:
    """Upper-cased, distinct, non-NULL words (marked words are upper-cased too, SURVEY Q28)."""
    return words.select(F.upper(F.col(column)).alias("word")).filter(F.col("word").isNotNull()).distinct()


DIGESTS = ["__d1", "__d2"]


def _with_digests(msgs: DataFrame, text: str) -> DataFrame:
    """Two 64-bit digests of the text: they stand for it in joins, so no text is a shuffle key."""
    return msgs.withColumns({"__d1": F.xxhash64(F.col(text)), "__d2": F.xxhash64(F.lit("second"), F.col(text))})


def _text_tokens(msgs: DataFrame, text: str) -> DataFrame:
    """Word tokens by the digests of their text; the verdict depends on the text alone, so no row id
    is needed."""
    return _with_digests(msgs.select(text), text).select(*DIGESTS, F.explode(F.array_distinct(word_tokens(text))).alias("word"))


def _of_texts(msgs: DataFrame, texts: DataFrame, text: str) -> DataFrame:
    return _with_digests(msgs, text).join(texts, DIGESTS, "left_semi").select(*msgs.columns)


def flag_messages(msgs: DataFrame, words: DataFrame, text: str = "message") -> DataFrame:
    """Messages in which some upper-cased word token is a marked word.

    Tokens are semi-joined to the marked words (Spark broadcasts a list that is small
    enough) and the digests of texts that hold one are semi-joined back; one path for any list length.
    """
    hits = _text_tokens(msgs, text).join(normalized_words(words), "word", "left_semi").select(*DIGESTS).distinct()
    return _of_texts(msgs, hits, text)


def flag_messages_in_vocab(msgs: DataFrame, words: DataFrame, vocab: DataFrame,
                           text: str = "message") -> DataFrame:
    """Variant: some token is marked and every token is in the vocabulary.

    Both lists are one table of words, so one join of the tokens and one aggregate per text answer
    both tests.
    """
    def listed(words, marked, known):
        return words.select(F.upper(F.col("word")).alias("word"), F.lit(marked).alias("marked"), F.lit(known).alias("known"))
    lists = (listed(words, True, False).unionByName(listed(vocab, False, True)).where("word IS NOT NULL")
             .groupBy("word").agg(F.max("marked").alias("marked"), F.max("known").alias("known")))
    texts = (_text_tokens(msgs, text).join(lists, "word", "left").groupBy(*DIGESTS)
             .agg(F.max("marked").alias("marked"), F.min(F.coalesce("known", F.lit(False))).alias("known")))
    return _of_texts(msgs, texts.where("marked AND known").select(*DIGESTS), text)


# J28 ------------------------------------------------------------------------------
def strike_events(flagged: DataFrame, flagged_at=None) -> DataFrame:
    """One event for the sender and one for the receiver of each flagged message.

    A missing participant gets no strike (SURVEY Q23); a message to oneself gives two
    (Q24). ``role`` tells the two apart (Q25). ``flagged_at`` is an optional time
    stamp column or value for ``start_date``.
    """
    people = F.array(
        F.struct(F.col("sender").cast("string").alias("employee_id"), F.lit("sender").alias("role")),
        F.struct(F.col("receiver").cast("string").alias("employee_id"), F.lit("receiver").alias("role")))
    ev = flagged.select(F.explode(people).alias("e")).select("e.employee_id", "e.role") \
                .filter(F.col("employee_id").isNotNull())
    if flagged_at is not None:
        ts = flagged_at if not isinstance(flagged_at, str) else F.lit(flagged_at).cast("timestamp_ntz")
        ev = ev.withColumn("start_date", ts)
    return ev


# J29 ------------------------------------------------------------------------------
def strike_counts(events: DataFrame) -> DataFrame:
    """New strikes per employee (partial aggregation before the shuffle)."""
    return events.groupBy("employee_id").agg(F.count(F.lit(1)).alias("strike_count"))
