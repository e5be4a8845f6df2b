"""Count-only Viterbi token counts of a unigram vocabulary.

The vocabulary (pieces and scores) is read from a public tokenizer file; its
path is a parameter.  Spaces become the word mark, with one in front of the
text, and no piece crosses from other characters into a word mark, so the best
path of a text is the chain of the best paths of its chunks (a run of marks and
what follows up to the next mark).  Each chunk is segmented once per worker and
its count kept in a bounded cache.

Within a chunk an Aho-Corasick automaton enumerates the vocabulary matches and
dynamic programming carries, for each end position, the best score and its
number of tokens - no pieces, no back pointers.  The tie rules are the
tokenizer's: starts are visited in order and only a strictly better score
replaces one, so among equal scores the earliest start wins; a character that is
no piece is an unknown of the lowest score less ``UNKNOWN_PENALTY`` and costs one
token per UTF-8 byte (byte fallback).

Defined results: null and empty texts have 0 tokens; repeated rows are counted
one by one; null ids are kept; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Default vocabulary file, and the tokenizer's penalty of an unknown character.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
MARK = "▁"
#: Distinct chunks a worker keeps, and the longest chunk it keeps.
CACHE, CACHED_LENGTH = 300_000, 48
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BYTE = re.compile(r"<0x[0-9A-F]{2}>")


def read_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Token counter of one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        special = {p for p, _ in vocabulary if _BYTE.fullmatch(p)} | {"<unk>", "<s>", "</s>"}
        pieces = [(p, s) for p, s in vocabulary if p not in special]
        crossing = [p for p, _ in pieces if MARK in p.lstrip(MARK)]
        if crossing:
            raise ValueError(f"pieces with a word mark inside cannot be cut into chunks: {crossing[:3]}")
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for p, s in pieces:
            self.automaton.add_word(p, (len(p), s))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.cache: dict[str, int] = {}

    def _segment(self, chunk: str) -> int:
        """Tokens of the best path through one chunk.

        Matches come by end position; at each end the longest match (the
        earliest start) comes first, which is the order the tie rule asks for.
        """
        n = len(chunk)
        by_end: list = [None] * n
        for end, match in self.automaton.iter(chunk):
            if by_end[end] is None:
                by_end[end] = [match]
            else:
                by_end[end].append(match)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        single, unknown = self.single, self.unknown
        for end in range(n):
            best, tokens = None, 0
            found = by_end[end]
            if found is not None:
                found.sort(reverse=True)
                for length, s in found:
                    at = end + 1 - length
                    total = score[at] + s
                    if best is None or total > best:
                        best, tokens = total, count[at] + 1
            if chunk[end] not in single:
                total = score[end] + unknown
                if best is None or total > best:
                    best, tokens = total, count[end] + len(chunk[end].encode("utf-8", "surrogatepass"))
            score[end + 1], count[end + 1] = best, tokens
        return count[n]

    def count(self, text: str | None) -> int:
        """Tokens of a whole text."""
        if not text:
            return 0
        total, cache = 0, self.cache
        for chunk in _CHUNK.findall(MARK + text.replace(" ", MARK)):
            n = cache.get(chunk)
            if n is None:
                n = self._segment(chunk)
                if len(chunk) <= CACHED_LENGTH:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[chunk] = n
            total += n
        return total


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row."""
    # A vocabulary's size is fixed by its file (about a megabyte).
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["i"], "n_tokens": [counter.count(t) for t in pdf["t"]]})

    out = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).mapInPandas(run, "doc_id string, n_tokens bigint")
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "n_tokens")
