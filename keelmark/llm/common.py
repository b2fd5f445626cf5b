"""Small helpers that the operators share."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelmark.sources.tables import stored

#: The six bytes that part words, as the contracts of the operators have it.
SPACES = r"\x20\x09-\x0D"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

__all__ = ["SPACES", "empty_partitions", "identified", "lowered_words", "remainder", "stored", "word_count"]


def identified(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: whatever else a table carries cannot clash."""
    return docs.select(docs[id_column].alias("doc_id"), docs[text_column].cast("string").alias("text"))


def lowered_words(text: str | None) -> list[bytes]:
    """Words as UTF-8, A-Z lowered; ``bytes.split`` parts at the same six characters."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def remainder(id_column: str | Column, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % by


def word_count(text: str | Column) -> Column:
    """Number of words; null and blank texts have none."""
    column = F.col(text) if isinstance(text, str) else text
    # each maximal run of word characters counts once, without building an array of words
    return F.coalesce(F.regexp_count(column, F.lit(f"[^{SPACES}]+")), F.lit(0)).cast("bigint")


def empty_partitions(df: DataFrame, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([], schema)
