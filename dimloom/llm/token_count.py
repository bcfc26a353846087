"""Token counts of whole texts by byte-pair merging with a heap and a linked list.

``merge_count`` repeatedly pops the best-ranked adjacent pair (leftmost among equals) and joins it; the number of
tokens is the number of initial symbols minus the merges. No token identifier is formed. The vocabulary is read from
the tokenizer's file as a table piece -> rank; its path is a parameter.

Only pieces that start with the word mark hold it after another character in none of the vocabularies used here
(checked when the table is loaded), so no merge crosses from a character to a following word mark and a text's count
is the sum over its words. Each task keeps the counts of recent words in a table of bounded size.

Defined results: null and empty texts have 0 tokens; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import table, text_bytes

MARK = "▁"  # the word mark that stands for a space
#: Most words whose counts a task keeps; beyond it the table starts anew.
KEPT_WORDS = 1_000_000


def load_pieces(path: str) -> tuple[dict[str, int], bool]:
    """piece -> rank of a sentencepiece BPE model (lower ranks merge first); whether unknown characters fall back to bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, fallback = {}, False
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            fallback = True
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            scores[model.id_to_piece(i)] = model.get_score(i)
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in scores):
        raise ValueError("a piece crosses from a character to a word mark; texts can't be counted by words")
    rank = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
    return {p: rank[s] for p, s in scores.items()}, fallback


def merge_count(text: str, ranks: dict[str, int], fallback: bool = True) -> int:
    """Tokens of one normalized word: symbols minus merges, where a symbol without a piece counts as its UTF-8 bytes."""
    n = len(text)
    symbols = [*text]
    get = ranks.get
    heap = [r * n + i for i, pair in enumerate(map(str.__add__, text, text[1:])) if (r := get(pair)) is not None]
    count = n
    if heap:
        heapify(heap)
        after = [*range(1, n + 1)]
        before = [*range(-1, n - 1)]
        while heap:
            rank, i = divmod(heappop(heap), n)
            left = symbols[i]
            if left is None or (j := after[i]) == n:
                continue  # this pair's left part is gone
            joined = left + symbols[j]
            if get(joined) != rank:
                continue  # one of its parts has grown meanwhile
            symbols[i] = joined
            symbols[j] = None
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get(joined + symbols[k])) is not None:
                    heappush(heap, r * n + i)
            if (h := before[i]) >= 0 and (r := get(symbols[h] + joined)) is not None:
                heappush(heap, r * n + h)
    if fallback:  # a character without a piece never merges: its initial symbols are its bytes
        for s in symbols:
            if s is not None and s not in ranks:
                count += len(s.encode("utf-8", "replace")) - 1
    return count


class WordCounts(dict):
    """word (with its mark) -> tokens, filled as words come, emptied when it holds `most`."""

    def __init__(self, ranks: dict[str, int], fallback: bool, most: int = KEPT_WORDS):
        super().__init__()
        self.ranks, self.fallback, self.most = ranks, fallback, most
        # Where no piece holds a Latin letter beside ASCII punctuation, a word's count is the sum over its runs.
        letter, other = "[A-Za-z\u00c0-\u024f]", "[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"
        crossing = re.compile(f"{letter}{other}|{other}{letter}")
        self.runs = None if any(map(crossing.search, ranks)) else re.compile(f"(?<={letter})(?={other})|(?<={other})(?={letter})")

    def __missing__(self, word: str) -> int:
        parts = self.runs.split(word) if self.runs and len(word) <= 64 else (word,)
        if len(parts) > 1:
            n = sum(map(self.__getitem__, parts))
        else:
            n = merge_count(word, self.ranks, self.fallback)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = n
        return n

    def text(self, text: str) -> int:
        """Tokens of a whole text: a mark goes before it, and each space is one (the model's own normalization).

        Words are runs `marks + other characters`; for single spaces that is a split at spaces."""
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        parts = text.split(" ")
        if "" not in parts:
            return sum(map(self.__getitem__, [MARK + p for p in parts]))
        total, marks, last = 0, "", len(parts) - 1
        for i, p in enumerate(parts):
            marks += MARK
            if p or i == last:
                total += self[marks + p]
                marks = ""
        return total


@functools.cache
def word_counts(path: str) -> WordCounts:
    """One table for each Python worker, which runs many tasks."""
    return WordCounts(*load_pieces(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; one pass, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_counts(path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            n_bytes, n_tokens = [], []
            for t in texts:
                t = t.as_py()
                n_bytes.append(len(text_bytes(t)))
                n_tokens.append(words.text(t or ""))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the piece_bpe_32k vocabulary."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
