"""A bounded memo of words.

Every public tokenizer used here splits at white space before it looks at a word, so a text
is the concatenation of its words' results, and remembering words saves most of the work.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import filterfalse


class Memo(dict):
    """Word -> result. Emptied when it would grow beyond ``most``, so a worker's memory is bounded."""

    def __init__(self, work: Callable[[list[str]], Iterable], most: int = 600_000):
        super().__init__()
        self.work, self.most = work, most

    def learn(self, words: Iterable[str]) -> None:
        """Make sure that each of ``words`` has a result; best called for a whole batch of texts at once."""
        words = set(words)
        new = list(filterfalse(self.__contains__, words))
        if not new:
            return
        if len(self) + len(new) > self.most and len(self):
            self.clear()
            new = list(words)
        self.update(zip(new, self.work(new)))


#: Marks that end a word; a run of them is one piece. Apostrophes, which begin contractions, and the signs of special tokens are not among them.
MARKS = ".,!?;:&$%*#@"


def is_run(word: str) -> bool:
    """Whether a word is of Latin letters alone."""
    return word.isalpha() and max(word) < "\u0250"
