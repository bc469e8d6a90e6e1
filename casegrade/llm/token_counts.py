"""Token counts under a unigram model, by dynamic programming over a trie.

A text's tokens are those of its pre-tokens (words between ASCII white space,
each led by the mark U+2581). The best segmentation of a pre-token maximises
the sum of its pieces' log probabilities; the best score of a prefix does not
depend on what follows. So distinct pre-tokens go into a trie whose nodes hold
the forward score and the token count of their prefix, computed once for all
pre-tokens that share it; the count at a pre-token's last node is its result.

Each task has a trie for the texts it reads, which starts anew at
``MAX_NODES`` nodes (a bound on memory, not on work). Nothing is shuffled.

The vocabulary is a public one, given by path. Its file ranks pieces but holds
no unigram probabilities; the piece of rank r gets the probability of Zipf's
law, 1 / ((r + 1) H). A character outside the vocabulary is its UTF-8 bytes, at
``UNKNOWN_PENALTY`` below the least score. Of equally good segmentations the one
with the longer last piece counts.

Defined cases: a null text has no tokens; equal texts get equal counts; one
output row for each input row; an empty table gives no rows; a text of any length
is counted whole (a task holds its words, and a path of the trie as long as its
longest word).
"""

from __future__ import annotations

import math
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0
MAX_NODES = 600_000


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def piece_scores(path: str | None) -> dict[str, float]:
    """Piece -> log probability; control, unknown and byte pieces are left out."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or default_vocabulary())
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    return {piece: -math.log(r + 1) - total for r, piece in enumerate(pieces)}


class Trie:
    """Forward scores and token counts by prefix."""

    def __init__(self, scores: dict[str, float], max_nodes: int = MAX_NODES):
        self.scores, self.max_nodes = scores, max_nodes
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self._clear()

    def _clear(self):
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.tokens = [0.0], [0]          # by node; node 0 is the empty prefix

    def _extend(self, word: str, path: list[int]) -> int:
        """The node for the prefix of ``word`` that is one longer than ``path``."""
        end = len(path)
        found = None
        for start in range(max(0, end - self.longest), end):
            score = self.scores.get(word[start:end])
            if score is not None:
                total = self.best[path[start]] + score
                if found is None or total > found[0]:
                    found = total, self.tokens[path[start]] + 1
        if word[end - 1] not in self.scores:
            total = self.best[path[end - 1]] + self.unknown
            if found is None or total > found[0]:
                found = total, self.tokens[path[end - 1]] + len(word[end - 1].encode("utf-8", "replace"))
        self.best.append(found[0])
        self.tokens.append(found[1])
        node = len(self.best) - 1
        self.child[path[-1], word[end - 1]] = node
        return node

    def insert(self, word: str) -> int:
        """Add a pre-token; the token count at its last node."""
        if len(self.best) > self.max_nodes:
            self._clear()
        path = [0]
        for ch in word:
            node = self.child.get((path[-1], ch))
            path.append(self._extend(word, path) if node is None else node)
        return self.tokens[path[-1]]


class _Counts(dict):
    """Word -> token count of its pre-token, kept while the trie is."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.trie.max_nodes:
            self.clear()
        found = self[word] = self.trie.insert(MARK + word.decode("utf-8", "replace"))
        return found


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocabulary_path: str | None = None, max_nodes: int = MAX_NODES) -> DataFrame:
    """(id, n_pretokens, n_tokens): one row per input row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    zero = F.lit(0).cast("long")
    schema = rows.select("id").withColumns({"n_pretokens": zero, "n_tokens": zero}).schema

    def task(batches):
        counts = _Counts(Trie(piece_scores(vocabulary_path), max_nodes))
        for run in slices(batches, 1):
            n_words, n_tokens = [], []
            for t in run.column(1):
                words = (t.as_py() or b"").split()
                n_words.append(len(words))
                n_tokens.append(sum(map(counts.__getitem__, words)))
            yield pa.RecordBatch.from_arrays(
                [run.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["id", "n_pretokens", "n_tokens"])
    return rows.mapInArrow(task, schema)
