"""Token counts of byte-level BPE by two tiers of pre-token lengths, without a shuffle of texts."""

from __future__ import annotations

import json
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightmarts.llm.common import small_batches, table, text_or_empty

LIMIT = 1024
# The frequent pre-tokens come from about so many documents; all others are counted exactly too.
SAMPLE_DOCS, FREQUENT = 5_000, 50_000
CACHE = 150_000  # further pre-tokens a worker remembers
KNOWN_LENGTH = 200  # characters of the longest pre-token that either of them holds

# White space as the tokenizer's pattern understands it.
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Characters whose class has been the same in every version of Unicode tables in
# use; a stretch between spaces with others is left to the tokenizer undivided.
_SETTLED = (
    r"\x00-\u036f\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u2030-\u205e\u20ac"
    r"\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)

# A space between two characters that are none begins a pre-token, whatever their class.
_SEAM = rf"(?<=[^{_SPACE}\u180e])(?= [^{_SPACE}\u180e])"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Counters:
    """Counts a text's tokens from its pre-tokens' lengths."""

    def __init__(self, definition: str, frequent: dict[str, int]) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        before, added = rules["pre_tokenizer"] or {}, rules["added_tokens"]
        if (
            rules["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"]
            or not before.get("use_regex", True)
            or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip"))
        ):
            raise ValueError("only plain byte-level BPE is supported")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        own = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, own))) if own else None
        self.cut = regex.compile(_PATTERN)
        self.odd = regex.compile(f"[^{_SETTLED}]")
        self.seam = regex.compile(_SEAM, regex.V1)
        self.frequent, self.seen = frequent, {}

    def _encoded(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def pre_tokens(self, text: str) -> list[str]:
        """What merges never cross; a stretch with odd characters may hold several."""
        parts = self.special.split(text) if self.special else [text]
        found = []
        for part in parts:
            if not self.odd.search(part):
                found += self.cut.findall(part)
                continue
            for stretch in self.seam.split(part):
                found += [stretch] if self.odd.search(stretch) else self.cut.findall(stretch)
        return found

    def count(self, text: str) -> int:
        specials = len(self.special.findall(text)) if self.special else 0
        frequent, seen = self.frequent, self.seen
        lengths = [frequent.get(p) or seen.get(p) or p for p in self.pre_tokens(text)]
        missed = sorted({p for p in lengths if p.__class__ is str})
        if missed:
            new = dict(zip(missed, self._encoded(missed), strict=True))
            kept = {p: n for p, n in new.items() if len(p) <= KNOWN_LENGTH}
            if len(seen) + len(kept) > CACHE:
                seen.clear()
            seen.update(kept)
            lengths = [new[p] if p.__class__ is str else p for p in lengths]
        return specials + sum(lengths)


def frequent_lengths(docs: DataFrame, definition: str) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of sampled rows: at most ``FREQUENT``.

    Rows are drawn one by one, so that neither their number nor a repeated id
    changes how many there are. Counts of tokens do not depend on them.
    """
    spark = docs.sparkSession
    sample = docs.sample(min(1.0, SAMPLE_DOCS / max(docs.count(), 1)), seed=6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, found = Counters(definition, {}), Counter()
        for batch in batches:
            for text in batch.column(0):
                found.update(p for p in counters.pre_tokens(text.as_py()) if len(p) <= KNOWN_LENGTH)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found)), pa.array(list(found.values()), pa.int64())], ["p", "n"]
            )

    small_batches(spark)
    top = (
        sample.select(text_or_empty().alias("text")).mapInArrow(run, "p string, n long")
        .groupBy("p").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "p").limit(FREQUENT)
    )
    own = [r["p"] for r in top.select("p").collect()]
    return dict(zip(own, Counters(definition, {})._encoded(own), strict=True)) if own else {}


def token_counts(docs: DataFrame, model: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``, one row per row of ``docs``.

    Tokens as the tokenizer of file ``model`` gives them: no begin or end
    tokens, special strings inside a text as that one token, no truncation. A
    null text is empty and has none. Repeated rows are counted each; an empty
    table gives an empty result. Reads ``doc_id`` and ``text`` only.

    Merges never cross pre-tokens, so a text has as many tokens as its
    pre-tokens together. Two tiers know their lengths: a broadcast table of the
    frequent ones, of at most 50,000 entries, and each worker's cache, which
    encodes what it meets first and is emptied when full. Nothing is shuffled.
    Where Unicode versions may differ on a character's class, the stretch from
    one single space to the next is looked up and encoded as a whole.
    """
    spark = docs.sparkSession
    with open(model or default_model(), encoding="utf-8") as file:
        definition = file.read()
    shared = spark.sparkContext.broadcast((definition, frequent_lengths(docs, definition)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters(*shared.value)
        for batch in batches:
            counts = [counters.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    schema = T.StructType([docs.schema["doc_id"]]).add("n_bytes", "long").add("n_tokens", "long")
    text = text_or_empty()
    counted = docs.select(
        "doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    ).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
