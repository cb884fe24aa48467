"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A chunk's tokens are joined to the next chunk's at a boundary that is proven to be one of the
whole text. The pre-tokenizer of a byte-level BPE scans from left to right and looks ahead by
one character, and each of its pieces is encoded by itself. So a piece boundary of a chunk
that starts at a true boundary is true as long as the piece behind it ends before the chunk's
last few characters (in which a special token might have been cut). From a true boundary on
any scan runs alike; if the next chunk has a piece boundary at the same place, its tokens
from there on are the whole text's. Without a common boundary the overlap is doubled, and
when it has reached the chunk's start, the chunk. Where this proof does not hold (a
normaliser, another pre-tokenizer), texts are encoded whole.

Texts of one chunk are encoded whole, where that gives the same ids by tiktoken with the
file's vocabulary, which takes a third of the time.

Null counts as an empty text. Rows are counted one by one, whatever repeats.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

CHUNK = 1 << 15  # characters
OVERLAP = 1 << 9
BATCH_CHARS = 1 << 18


def load(path: str):
    """Tokenizer of a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file."""
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def fast_encoder(path: str):
    """tiktoken encoder with the vocabulary of a byte-level BPE file of tokenizers, or None.

    It merges by rank, which gives the same ids where the file's merges are in the order of
    their ids and nothing but the byte-level pattern comes before them; else there is none.
    """
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    model, vocabulary = made["model"], made["model"].get("vocab", {})
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
           "byte_fallback", "ignore_merges")
    if model.get("type") != "BPE" or any(model.get(k) for k in odd) or not spliceable(load(path)):
        return None
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        return None
    import tiktoken
    from tokenizers import pre_tokenizers

    shown = set(pre_tokenizers.ByteLevel.alphabet())  # one character for each byte
    byte = {chr(b): b for b in range(256) if chr(b) in shown}
    byte.update(zip(sorted(shown - set(byte)), (b for b in range(256) if chr(b) not in shown)))
    special = {t["content"]: t["id"] for t in made["added_tokens"]}
    ranks = {
        bytes(byte[c] for c in token): i for token, i in vocabulary.items() if token not in special
    }
    # fixed values: the pattern of tokenizers' ByteLevel pre-tokenizer
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("fast", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


_KNOWN: dict[int, tuple] = {}  # a tokenizer, whether it can be spliced, its margin


def _known(tokenizer) -> tuple:
    found = _KNOWN.get(id(tokenizer))
    if found is None:
        found = _KNOWN[id(tokenizer)] = (tokenizer, spliceable(tokenizer), _margin(tokenizer))
    return found


def spliceable(tokenizer) -> bool:
    """Whether a common piece boundary proves that two encodings agree from there on."""
    made = json.loads(tokenizer.to_str())
    pre = made["pre_tokenizer"] or {}
    plain = [t for t in made["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
    return (
        made["normalizer"] is None
        and made["post_processor"] is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space", True)
        and not plain
    )


def _margin(tokenizer) -> int:
    added = [len(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
    return max(added, default=0) + 2


def _pieces(tokenizer, text: str, at: int, to: int):
    """Ids of ``text[at:to]``, and where its pieces start: {character: token}."""
    found = tokenizer.encode(text[at:to], add_special_tokens=False)
    starts, before = {}, object()
    for k, (word, (start, _)) in enumerate(zip(found.word_ids, found.offsets)):
        if word != before or word is None:
            starts[at + start] = k
            before = word
    return found.ids, starts


def encode_long(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[list]:
    """Lists of ids that make up the encoding of ``text``; no list spans many chunks."""
    if len(text) <= chunk or not _known(tokenizer)[1]:
        yield tokenizer.encode(text, add_special_tokens=False).ids
        return
    margin, n = _known(tokenizer)[2], len(text)
    at, size = 0, chunk  # ``at`` is a true boundary
    to = min(n, at + size)
    ids, starts = _pieces(tokenizer, text, at, to)
    first = 0  # tokens of ``ids`` before this one have been given out
    while to < n:
        order = sorted(starts)
        ends = [*order[1:], to]
        true = {p for p, end in zip(order, ends) if p > at and end <= to - margin}
        over, joint = overlap, None
        while joint is None and over < to - at:
            begin = to - over
            ids2, starts2 = _pieces(tokenizer, text, begin, min(n, begin + chunk))
            joint = max((p for p in starts2 if p in true), default=None)
            over *= 2
        if joint is None:  # no boundary within the chunk: take a longer one
            size *= 2
            to = min(n, at + size)
            ids, starts = _pieces(tokenizer, text, at, to)
            first = 0
            continue
        yield ids[first : starts[joint]]
        to, size = min(n, begin + chunk), chunk
        ids, first, at = ids2, starts2[joint], joint
        starts = {p: k for p, k in starts2.items() if p >= joint}
    yield ids[first:]


def _in_batches(texts: list[str], most: int) -> Iterator[list[int]]:
    """Positions of texts, some thousand characters at a time."""
    batch, size = [], 0
    for i, text in enumerate(texts):
        batch.append(i)
        size += len(text)
        if size >= most:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def count_texts(tokenizer, texts: list[str], chunk: int = CHUNK, fast=None) -> list[int]:
    counts = [0] * len(texts)
    if hasattr(tokenizer, "piece_to_id"):
        for i, text in enumerate(texts):
            counts[i] = len(tokenizer.encode(text, num_threads=1))
        return counts
    short = [i for i, text in enumerate(texts) if len(text) <= chunk]
    if fast is not None:
        for i in short:
            counts[i] = len(fast.encode(texts[i], allowed_special="all"))
        short = []
    for batch in _in_batches([texts[i] for i in short], BATCH_CHARS):
        found = tokenizer.encode_batch_fast(
            [texts[short[k]] for k in batch], add_special_tokens=False
        )
        for k, encoding in zip(batch, found):
            counts[short[k]] = len(encoding)
    for i, text in enumerate(texts):
        if len(text) > chunk:
            counts[i] = sum(map(len, encode_long(tokenizer, text, chunk)))
    return counts


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, fast = load(path), fast_encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                n_bytes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
                n_tokens = count_texts(tokenizer, texts, fast=fast)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_bytes, pa.int64()),
                     pa.array(n_tokens, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    schema = StructType(
        [rows.schema["doc_id"], StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    )
    return rows.mapInArrow(run, schema)
