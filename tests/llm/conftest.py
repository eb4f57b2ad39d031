import pytest
from pyspark.sql import Row


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty and long texts, repeats and columns whose
    names clash with the operators' own."""
    rows = [(1, "the cat sat on the mat and looked at the small dog"),
            (2, "the cat sat on the mat and looked at the small dog"),
            (3, ""), (4, None), (None, "a text without key that is its own"),
            (5, "word " * 5000 + "end"), (6, "Über straße größe ñandú çedilla 你好 мир"),
            (6, "Über straße größe ñandú çedilla 你好 мир"), (7, "  spaced\n\n out\ttext  "),
            (8, "it's we'll <|endoftext|> done 12 345 !!! --")]
    return spark.createDataFrame(
        [Row(doc_id=i, text=t, lang="en", start=0, length=9, word="w", block=1, fp=2, slots=b"", again=1, kept=2)
         for i, t in rows],
        "doc_id long, text string, lang string, start int, length int, word string, block int, fp int, slots binary, "
        "again int, kept int")


@pytest.fixture
def empty(docs):
    return docs.limit(0)
