"""Operator 8: token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton over the vocabulary gives every piece that ends at a position; the
dynamic programme keeps per position the best score and the number of pieces on that path,
and nothing else. Ties are settled as the tokenizers library does: of equal scores, the piece
that starts first stays. Pieces are looked for in each word with its leading space mark, as
the tokenizer's pre-tokenizer cuts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, map_arrow, table
from .words import Memo

MARK = "▁"
#: What an unknown character scores below the lowest piece: a fixed value of the tokenizers library.
UNKNOWN_PENALTY = 10.0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in id order; the scores are taken as unigram log weights."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())]


class Counter:
    """Piece counts of words under one vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        self.auto = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.auto.add_word(piece, (len(piece), score))
        self.auto.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        names = {p for p, _ in vocabulary}
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))

    def count(self, word: str) -> int:
        """Pieces on the best path through ``word``; an unknown character is as many pieces as it has bytes."""
        low, unknown = float("-inf"), self.unknown
        best, pieces = [0.0], [0]  # of each end that is final
        end, top, number, whole = 1, low, 0, False  # of the end at work
        stop = [(len(word), (0, low))] if word else []  # makes the last ends final
        for last, (k, score) in chain(self.auto.iter(word), stop):
            while end <= last:
                if not whole and (s := best[-1] + unknown) > top:
                    top, number = s, pieces[-1] + (len(word[end - 1].encode()) if self.bytes else 1)
                best.append(top)
                pieces.append(number)
                end, top, whole = end + 1, low, False
            if (s := best[last + 1 - k] + score if k else low) > top:
                top, number = s, pieces[last + 1 - k] + 1
            if k == 1:
                whole = True
        return pieces[len(word)]


@lru_cache(maxsize=2)
def _counter(path: str) -> tuple[Counter, Memo]:
    c = Counter(unigram_vocabulary(path))
    return c, Memo(lambda words: [c.count(MARK + w) for w in words])


def marked_words(text: str) -> list[str]:
    """The words between single spaces, each of which the tokenizer sees behind one space mark.

    A text that starts with a space, or with the mark itself, gets no further mark before it.
    """
    words = text.replace(MARK, " ").split(" ")
    return words[1:] if text[:1] in (" ", MARK) else words


def count_texts(texts: list[str], path: str) -> list[int]:
    """Tokens of whole texts."""
    memo = _counter(path)[1]
    words = [marked_words(t) if t else [] for t in texts]
    memo.learn(chain.from_iterable(words))
    return [sum(map(memo.__getitem__, w)) for w in words]


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens``, a row per input row; null and empty texts have none. Other columns are not read."""
    path = path or default_path()
    base = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(count_texts(b.column("text").to_pylist(), path), pa.int64())], ["doc_id", "n_tokens"])

    return map_arrow(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, n_tokens bigint")


def query(spark, sf_dir: str) -> DataFrame:
    """Registered query ``op8_token_counts``."""
    return count_tokens(table(spark, sf_dir, "documents"))
