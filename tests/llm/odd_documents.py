from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
BLOCK = "The same passage of many words stands here again and again in several texts. " * 8

# Extra columns are named like columns that operators use inside.
CLASHING = [
    "row", "size", "n", "first", "word", "_word", "_bit", "norm", "length", "prefix", "kept",
    "t", "t1", "t2", "near", "node", "component", "score", "label", "ids", "base", "email",
    "start", "end", "source_no", "target", "copies", "_copy", "payload", "digest", "value",
    "w1", "phrase", "rank", "tie", "_tie", "weight", "bucket", "buckets", "counts", "_text", "added", "kind",
]

TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "one two three four",
    "one  two\nthree four",
    "a b c d e f g h i j k l m n o p q r s t",
    "a b c d e f g h i j k l m n o p q r s u",
    BLOCK,
    BLOCK,
    BLOCK + "with another end",
    "before it " + BLOCK,
    "é " * 30_000,
    "x" * 50_000,
    "word " * 3_000,
    "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 4,
    "mail a.b@c.de, 10.0.0.256 10.0.0.25, 4111 1111 1111 1111, +46 (8) 123 456 78",
    "<|endoftext|>don't  <|endoftext|>\x1c\x85　​▁ 你好 🙂",
    "line\nline\n\n line\nline",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Texts of every odd kind, with null and repeated ids, beside the smallest test data."""
    rows = [
        (1_000_000 + i, text, [None, "en", "xx"][i % 3], [None, "src1", "odd"][i % 3], i)
        for i, text in enumerate(TEXTS)
    ]
    rows += [rows[8], (None, "no id at all", "en", "odd", 0), (None, BLOCK, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs = docs.union(spark.read.parquet(f"{SF_DIR}/documents.parquet").select(docs.columns))
    clashing = {c: F.lit("clash") for c in CLASHING}
    docs = docs.withColumns(clashing).coalesce(3)
    path = __import__("tempfile").mkdtemp(prefix="odd-") + "/documents"
    docs.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def plain(odd):
    """The same rows in Python: id, text (null: empty), language, source."""
    return [
        (r["doc_id"], r["text"] or "", r["lang"], r["source"])
        for r in odd.select("doc_id", "text", "lang", "source").collect()
    ]


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
