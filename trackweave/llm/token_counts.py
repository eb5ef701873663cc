"""Token counts by a linear longest-match automaton.

The vocabulary becomes a trie whose nodes carry a failure link and the number of tokens that are popped
on the way: when no edge fits the next character, the longest matched tokens so far are counted off and
matching goes on from the failure node, without reading a character twice and without building a piece.
The count equals that of greedy longest-match-first word pieces.

The vocabulary is that of a public tokenizer file: its pieces that begin a word, and those that go on
inside one. Words are `[^\\x20\\x09-\\x0D]+`. A word with a stretch that no piece covers is one unknown
token; so is a word of more than `max_word` characters if that is set (None: no limit).

Defined cases: null and empty texts have no words and no tokens; repeated rows are counted alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words whose counts a task remembers at most.
REMEMBER = 300_000
_SHIFT = 21


def vocabulary(path: str = VOCABULARY) -> tuple[list[str], list[str]]:
    """Pieces that begin a word and pieces that continue one, from a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    initial = {p[1:] for p in pieces if p.startswith(MARK)}
    return sorted(x for x in initial if x and MARK not in x), sorted(x for x in set(pieces) if x and MARK not in x)


class Automaton:
    """Longest-match counting over `initial` pieces (word beginnings) and `inner` pieces (continuations)."""

    def __init__(self, initial: Iterable[str], inner: Iterable[str]):
        # node 0 is the beginning of a word, node 1 the place after a piece
        self.edges: dict[int, int] = {}
        ends = {}
        n = 2
        for root, pieces in ((0, initial), (1, inner)):
            for piece in pieces:
                node = root
                for c in piece:
                    key = node << _SHIFT | ord(c)
                    if key not in self.edges:
                        self.edges[key] = n
                        n += 1
                    node = self.edges[key]
                ends[node] = True
        #: where matching goes on, -1 if nowhere, and the tokens popped on the way there
        self.fail, self.pops = [-1] * n, [0] * n
        below: dict[int, list[tuple[int, int]]] = {}
        for key, child in self.edges.items():
            below.setdefault(key >> _SHIFT, []).append((key & (1 << _SHIFT) - 1, child))
        queue = deque([0, 1])
        while queue:
            node = queue.popleft()
            for c, child in below.get(node, ()):
                if child in ends:
                    self.fail[child], self.pops[child] = 1, 1
                else:
                    back, popped = self.fail[node], self.pops[node]
                    while back >= 0 and (back << _SHIFT | c) not in self.edges:
                        popped += self.pops[back]
                        back = self.fail[back]
                    if back >= 0:
                        self.fail[child], self.pops[child] = self.edges[back << _SHIFT | c], popped
                queue.append(child)

    def count(self, word: str) -> int:
        """Number of pieces of `word`; -1 if some stretch has none."""
        node, tokens, edges, fail, pops = 0, 0, self.edges, self.fail, self.pops
        for ch in word:
            c = ord(ch)
            while (to := edges.get(node << _SHIFT | c)) is None:
                if fail[node] < 0:
                    return -1
                tokens += pops[node]
                node = fail[node]
            node = to
        while node != 1:
            if fail[node] < 0:
                return -1
            tokens += pops[node]
            node = fail[node]
        return tokens


class _Counts(dict):
    """Counts of words by their bytes, found when they are first asked for."""

    def __init__(self, automaton: Automaton, max_word: int | None):
        super().__init__()
        self.automaton, self.max_word = automaton, max_word

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        text = word.decode()
        n = -1 if self.max_word is not None and len(text) > self.max_word else self.automaton.count(text)
        self[word] = n
        return n


def count_tokens(docs: DataFrame, path: str = VOCABULARY, max_word: int | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens and n_unknown of every row of `docs` (doc_id, text)."""
    initial, inner = vocabulary(path)
    shared = docs.sparkSession.sparkContext.broadcast((initial, inner))  # as large as the vocabulary file

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _Counts(Automaton(*shared.value), max_word).__getitem__
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in batch.column("text"):
                counts = list(map(get, (text.as_py() or "").encode().split()))
                bad = counts.count(-1)
                words.append(len(counts))
                tokens.append(sum(counts) + 2 * bad)  # an unknown word is one token
                unknown.append(bad)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(scan, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
