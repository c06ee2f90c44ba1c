"""Token counts with a whole-token shortcut.

Offline, every string of the vocabulary is encoded alone; those that come back as one token are proven whole tokens. A
pre-token that is a proven string counts one without any merging, and only the rest is merged by the library. Values of
recurring pieces are kept in a bounded memory, so a worker's cost follows the distinct pieces.

Defined results: a null text is empty and has 0 tokens; special strings inside a text count as the library counts them;
repeated rows give repeated results; any other columns, whatever their names, are left out.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidehouse.llm import arrow, encoding

_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


@functools.lru_cache(maxsize=2)
def prove_whole_tokens(name: str) -> frozenset[str]:
    """The vocabulary's strings, in byte letters, that the library encodes alone as exactly one token: their own."""
    tokenizer = encoding.loaded(name)
    text_of = {chr(letter): byte for byte, letter in encoding.BYTE_LETTERS.items()}
    specials = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    proven = []
    for letters, number in tokenizer.get_vocab().items():
        if letters in specials or any(c not in text_of for c in letters):
            continue
        try:
            text = bytes(text_of[c] for c in letters).decode()
        except UnicodeDecodeError:  # part of a character: never a pre-token
            continue
        if tokenizer.encode(text, add_special_tokens=False).ids == [number]:
            proven.append(letters)
    return frozenset(proven)


def counter(name: str, whole_tokens: frozenset[str]) -> encoding.PieceEncoder:
    """Texts to their number of tokens."""
    tokenizer = encoding.loaded(name)
    model = tokenizer.model

    def pre_token(letters: str) -> int:
        return 1 if letters in whole_tokens else len(model.tokenize(letters))

    return encoding.PieceEncoder(
        tokenizer, pre_token, sum, lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids), byte_level=True)


def _count(name: str, whole_tokens: Broadcast):
    def work(batches):
        count = counter(name, whole_tokens.value)
        for part in arrow.slices(batches, "text"):
            texts = part.column("text").to_pylist()
            yield arrow.batch(_OUT, part.column("doc_id"), part.column("n_bytes"), [count(t) for t in texts])

    return work


def token_counts(docs: DataFrame, name: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document; ``name`` is a byte-level BPE file of the tokenizers library.

    One narrow stage. The proven strings are broadcast; the vocabulary file bounds them.
    """
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(name))
    text = arrow.text_column()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                       text.alias("text"))
    counted = rows.mapInArrow(_count(name, whole), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
