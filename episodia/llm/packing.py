"""Best-fit packing of token sequences under several capacities."""

from __future__ import annotations

import functools
import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, trimmed

PIECE_SCHEMA = "id long, piece int, start long, length long, ids_crc32 long"
#: Words whose ids a task keeps.
CACHE_WORDS = 600_000


class WordTokens(dict):
    """Token ids of text between blanks, as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and joins nothing across it, so a text's ids are those of its parts in order. It
    also parts punctuation from a letter or digit before it, so "word" and "Word," need one encoding; and as each run
    of letters ends in a token with END, many such words can be encoded in one call.
    """

    END = "</w>"
    PUNCTUATION = "!\"#$%&'()*+,-./:;=?@[\\]^_`{|}~"

    def __init__(self, path: str) -> None:
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith(self.END)]] = True

    def divide(self, word: str) -> tuple[str, str]:
        """(core, punctuation) whose ids in order are the word's; the punctuation is empty where that isn't sure."""
        core = word.rstrip(self.PUNCTUATION)
        if core == word or not core or "<|" in word or not core[-1].lower()[-1].isalnum():
            return word, ""
        return core, word[len(core) :]

    @staticmethod
    def lowered(text: str) -> str:
        """The text in lower case, as the tokenizer makes it, if all its characters are below 256."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return text if "<|" in text else text.lower()

    def learn(self, words: set[str]) -> None:
        plain, rest = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
        blocks = [plain[i : i + 2000] for i in range(0, len(plain), 2000)]
        for block, got in zip(blocks, self.tokenizer.encode_batch_fast(["\n".join(b) for b in blocks], add_special_tokens=False), strict=True):
            ids = np.array(got.ids, "<u4")
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(block):
                rest += block
                continue
            raw, at = ids.tobytes(), 0
            for word, end in zip(block, (4 * last + 4).tolist(), strict=True):
                self[word], at = raw[at:end], end
        for word, got in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self[word] = struct.pack(f"<{len(got.ids)}I", *got.ids)

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        parts = [self.lowered(t).replace("\n", " ").split(" ") for t in texts]
        if len(self) > CACHE_WORDS:
            self.clear()
        divided = [(w, *self.divide(w)) for w in set().union(*parts) if w not in self]
        self.learn({x for d in divided for x in d[1:] if x not in self})
        for word, core, punctuation in divided:
            if punctuation:
                self[word] = self[core] + self[punctuation]
        for words in parts:
            yield b"".join(map(self.__getitem__, words))


@functools.cache
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, which keeps its words from task to task."""
    return WordTokens(path)


def _batches(texts: list[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    begin = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= chars:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of a document's ids, ended by id 0: id, piece, start, length, crc32 of the ids.

    Documents of up to max_tokens are one piece; longer ones are cut into pieces of max_tokens, the last may be
    shorter. Null text counts as empty: one piece with id 0 alone.
    """

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, size = word_tokens(tokenizer_path), 4 * max_tokens
        for frame in frames:
            texts, keys, out = frame["text"].fillna("").tolist(), frame["id"].tolist(), []
            for a, b in _batches(texts):
                for key, ids in zip(keys[a:b], words.ids(texts[a:b]), strict=True):
                    ids += b"\0\0\0\0"
                    out += [(key, k, k * max_tokens, (min(len(ids), at + size) - at) // 4, zlib.crc32(ids[at : at + size])) for k, at in enumerate(range(0, len(ids), size))]
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(trimmed(pieces), PIECE_SCHEMA)


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)) -> tuple[np.ndarray, np.ndarray]:
    """Vector best fit, longest first: (bin, offset) of every item.

    An item needs (its tokens, 1 document, tokens squared of attention cost). Of the open bins in which all three fit,
    the one is taken whose weighted residual after placing has the smallest norm; the weights let the tokens decide
    first. An item that fits nowhere opens a bin. Ties go to the earlier bin.
    """
    cap = np.array(capacity, dtype=np.float64)
    n = len(lengths)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.argsort(-lengths, kind="stable")
    shortest = int(lengths.min()) if n else 0
    rest, names, used = np.empty((256, 3)), np.empty(256, np.int64), np.zeros(n, np.int64)
    opened = count = 0
    for i in order:
        need = np.array((lengths[i], 1.0, float(lengths[i]) ** 2))
        if (need > cap).any():
            raise ValueError(f"a piece of {lengths[i]} tokens exceeds a capacity of {capacity}")
        at = -1
        if opened:
            after = rest[:opened] - need
            norm = ((after / cap) ** 2) @ np.array(weights)
            norm[(after < 0).any(axis=1)] = np.inf
            at = int(norm.argmin())
            at = at if np.isfinite(norm[at]) else -1
        if at < 0:
            if opened == len(rest):
                rest, names = np.concatenate([rest, np.empty_like(rest)]), np.concatenate([names, np.empty_like(names)])
            at, rest[opened], names[opened] = opened, cap, count
            opened, count = opened + 1, count + 1
        rest[at] -= need
        bins[i], offsets[i] = names[at], used[names[at]]
        used[names[at]] += lengths[i]
        if rest[at, 0] < shortest or rest[at, 1] < 1:  # full: nothing can be added
            opened -= 1
            rest[at], names[at] = rest[opened], names[opened]
    return bins, offsets


def pack_pieces(pieces: DataFrame, max_tokens: int = 2048, max_docs: int = 2048, max_cost: int = 2048**2, group_rows: int = 8192) -> DataFrame:
    """pieces plus sequence_id and offset. pieces must be a materialized table, so that a repeated task deals it alike.

    The rows are dealt evenly into groups of about group_rows, and each is packed by itself. What lies in sequences that
    a group left open by more than a sixty-fourth is dealt and packed once more, all groups' together.
    """

    def packer(number: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows = [f for f in frames if len(f)]
            if rows:
                rows = pd.concat(rows, ignore_index=True)
                lengths = rows["length"].to_numpy()
                bins, offsets = best_fit(lengths, (max_tokens, max_docs, max_cost))
                first = (number << 60) + (TaskContext.get().partitionId() << 32)
                yield rows.assign(sequence_id=bins + first, offset=offsets, filled=np.bincount(bins, lengths).astype(np.int64)[bins])

        return pack

    def packed(rows: DataFrame, n: int, number: int) -> DataFrame:
        return rows.repartition(max(1, -(-n // group_rows))).mapInPandas(packer(number), PIECE_SCHEMA + ", sequence_id long, offset long, filled long")

    n = pieces.count()
    first = packed(pieces, n, 0)
    if n > group_rows:
        first = materialize(first, "packed")
        is_open = F.col("filled") < max_tokens - max_tokens // 64
        left = materialize(first.where(is_open).select(*pieces.columns), "open")
        first = first.where(~is_open).unionByName(packed(left, left.count(), 1))
    return first.drop("filled")


def pack_documents(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, max_docs: int | None = None, max_cost: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize docs and pack them into few sequences: id, piece, start, length, ids_crc32, sequence_id, offset.

    max_docs limits the documents of a sequence and max_cost the sum of their squared lengths; by default neither
    binds beyond max_tokens. Null text counts as empty; rows with the same id are packed each by itself; an empty
    table gives no rows; further columns are ignored.
    """
    pieces = materialize(tokenize_pieces(docs, tokenizer_path, max_tokens, id_col, text_col), "pieces")
    packed = pack_pieces(pieces, max_tokens, max_docs or max_tokens, max_cost or max_tokens**2)
    return packed.withColumnRenamed("id", id_col)


def word_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), word_bpe())
