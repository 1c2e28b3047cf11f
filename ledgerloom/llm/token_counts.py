"""Token counts under a unigram vocabulary, with a trie that shares prefixes.

A word is cut into the pieces whose scores have the largest sum. The distinct
words of some documents are inserted in a trie; each node holds the best score
of the prefix it stands for and the pieces in it, computed once from its
ancestors however many words go through it. The count at a word's last node is
the word's count, and a document's count is a sum over its words.

The vocabulary is a file of a public tokenizer, read by the driver and sent to
the tasks (its size is checked). Nothing is trained and nothing is shuffled.
"""
from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks as b
from ledgerloom.llm import words as w
from ledgerloom.session import ship

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MOST_PIECES = 1 << 20  # a larger vocabulary is refused, as every task holds it
SPACE = "▁"       # stands for the gap before a word in such files
OFFSET = 2.7           # of ranks, for scores by Zipf and Mandelbrot
UNKNOWN = 10.0         # how far an unknown character scores below the rarest piece
NODES = 400_000        # of a task's trie, before it starts afresh
WORDS = 600_000        # in a task's table of counts, before the older half goes
LONG = 256             # characters from which a word is not put into the trie
RESULT = "doc_id long, n_words long, n_tokens long"


class Vocabulary(NamedTuple):
    scores: dict[str, float]
    longest: int
    unknown: float  # score of a character that is no piece; it counts as its bytes
    ends: dict[str, float | None]  # all that a piece may end with, and its score if it is a piece itself


def of_scores(scores: dict[str, float]) -> Vocabulary:
    if len(scores) > MOST_PIECES:
        raise ValueError(f"{len(scores)} pieces; at most {MOST_PIECES} go to every task")
    ends: dict[str, float | None] = {piece[k:]: None for piece in scores for k in range(1, len(piece))}
    return Vocabulary(scores, max(map(len, scores), default=1), min(scores.values(), default=0.0) - UNKNOWN, ends | scores)


def load(path: str = VOCABULARY, as_given: bool = False) -> Vocabulary:
    """Pieces of a sentencepiece file. Merge ranks are no probabilities, so the scores follow from the ranks unless ``as_given``."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    if as_given:
        return of_scores(dict(pieces))
    pieces.sort(key=lambda p: -p[1])
    return of_scores({piece: -math.log(rank + OFFSET) for rank, (piece, _) in enumerate(pieces)})


_NONE = object()


def _step(word: str, end: int, best: Callable[[int], tuple[float, int]], known: Vocabulary) -> tuple[float, int]:
    """Best score of the first ``end`` characters and its pieces, from those of shorter prefixes (``best``, by length); the fewest pieces on a tie.

    Pieces are tried from the shortest on, as long as some piece may end so.
    """
    ends, found = known.ends, None
    for start in range(end - 1, -1, -1):
        score = ends.get(word[start:end], _NONE)
        if score is _NONE:
            break
        if score is not None:
            total, n = best(start)
            if found is None or total + score > found[0] or total + score == found[0] and n + 1 < found[1]:
                found = total + score, n + 1
    char = word[end - 1]
    if char not in known.scores:
        total, n = best(end - 1)
        if found is None or total + known.unknown > found[0]:
            found = total + known.unknown, n + len(char.encode("utf-8", "surrogatepass"))
    return found


def count_alone(word: str, known: Vocabulary) -> int:
    """Without a trie; scores of prefixes that no further piece can reach are let go."""
    best: list = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best.append(_step(word, end, best.__getitem__, known))
        if end > known.longest:
            best[end - known.longest - 1] = None
    return best[-1][1]


class Trie:
    """Of each prefix of the words so far the best score and the pieces in it. A node is named by its prefix, so the longest known
    prefix of a word is found from its end: most words differ from an earlier one in their last characters alone."""

    def __init__(self, known: Vocabulary):
        self.known, self.nodes = known, {"": (0.0, 0)}

    def count(self, word: str) -> int:
        nodes, at = self.nodes, len(word)
        while (best := nodes.get(word[:at])) is None:
            at -= 1
        for end in range(at + 1, len(word) + 1):
            best = nodes[word[:end]] = _step(word, end, lambda start: nodes[word[:start]], self.known)
        return best[1]


class Counter:
    """Counts of words for one task."""

    def __init__(self, known: Vocabulary):
        self.known, self.trie, self.table = known, Trie(known), {}

    def add(self, words: set[bytes]) -> None:
        if len(self.trie.nodes) > NODES:
            self.trie = Trie(self.known)
        if len(self.table) + len(words) > WORDS:
            self.table = dict(itertools.islice(self.table.items(), len(self.table) // 2, None))
        for raw in words:
            if raw not in self.table:
                word = SPACE + raw.decode("utf-8", "replace")
                self.table[raw] = count_alone(word, self.known) if len(word) > LONG else self.trie.count(word)

    def total(self, words: list[bytes]) -> int:
        n = 0
        for k in range(0, len(words), WORDS // 4):
            some = words[k:k + WORDS // 4]
            self.add(set(some))
            n += sum(map(self.table.__getitem__, some))
        return n


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | Vocabulary = VOCABULARY) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_tokens``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text, each with the gap before it; gaps give no tokens of their own. A character
    that is no piece counts as its UTF-8 bytes.

    Null and empty texts have 0 of both; words of any length are counted whole; repeated rows and ids get a row each; other
    columns are ignored; an empty table gives no rows.
    """
    spark = ship(docs.sparkSession)
    known = spark.sparkContext.broadcast(vocabulary if isinstance(vocabulary, Vocabulary) else load(vocabulary))

    def each(batches):
        counter = Counter(known.value)
        for batch in batches:
            for i, j in b.pieces(batch):
                data, at = w.buffer(batch.column("text").slice(i, j - i))
                raw, texts = data.tobytes(), []
                for a, z in zip(at.tolist(), at[1:].tolist()):
                    texts.append(raw[a:z].split())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(i, j - i), pa.array([len(t) for t in texts], pa.int64()), pa.array([counter.total(t) for t in texts], pa.int64())],
                    names=["doc_id", "n_words", "n_tokens"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(each, RESULT)
