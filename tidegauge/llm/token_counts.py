"""Token counts by a linear longest-match automaton.

A text's words (white space apart, A-Z lower-cased) are split greedily: the longest piece of the
vocabulary that a word starts with, then the longest that the rest starts with, and so on. The
automaton is the vocabulary's trie with failure links: where a node has no child for the next
byte, the pieces that greedy matching would emit by then are popped, and the failure link leads to
the node that the unread rest of the match spells. Only the number of popped pieces is stored, so a
word's count is a sum over its bytes, each read once, and no piece is ever built.

The vocabulary file is the path ``vocabulary`` (a byte-level word-piece list in JSON, of which
pieces ending in the word-end mark may only end a word); its automaton is built once on the driver,
some megabytes whatever the corpus, and travels as a broadcast variable. Documents are counted where
they are read, without a shuffle. Counts of words are kept in a bounded table per task.

Defined cases: null and empty texts have no words and no pieces; a byte that starts no piece is one
unknown piece by itself (counted in ``n_unknown`` too), so every byte is accounted for; very long words are read byte by byte; repeated rows and
null ids are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table

VOCABULARY = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/word_bpe_49k.json"
#: Words whose counts a task remembers.
REMEMBERED = 200_000
#: Appended to each word; pieces that may only end a word end with it. No UTF-8 text has this byte.
WORD_END = 0xFF


def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write for the 256 bytes: visible Latin-1
    characters stand for themselves, the other bytes follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def load_pieces(path: str, end_mark: str = "</w>") -> list[bytes]:
    """The vocabulary's pieces as bytes, word ends as ``WORD_END``."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters, pieces = byte_alphabet(), []
    for piece in model["vocab"]:
        body = piece.removesuffix(end_mark)
        if body and all(c in letters for c in body):
            pieces.append(bytes(letters[c] for c in body) + (bytes([WORD_END]) if body != piece else b""))
    return pieces


class Automaton:
    """Trie, failure links and popped-piece counts of a vocabulary.

    ``step`` maps node * 256 + byte to the child; ``fail`` and ``pops`` belong to a node: where to go
    on when there is no child, and how many pieces that emits (of them ``lost`` unknown). The failure
    link of a node whose string greedy matching cannot take apart is the root's and pops its first
    byte as unknown.
    """

    def __init__(self, pieces: Iterable[bytes]):
        self.step: dict[int, int] = {}
        whole = [False]
        parents: list[tuple[int, int]] = [(0, 0)]
        for piece in pieces:
            node = 0
            for byte in piece:
                node = self._child(node, byte, parents, whole)
            whole[node] = True
        for byte in range(256):  # a byte that starts no piece has a node of its own, which pops it as unknown
            self._child(0, byte, parents, whole)
        count = len(parents)
        self.fail, self.pops, self.lost = [0] * count, [0] * count, [0] * count
        self.whole = whole
        children: list[list[int]] = [[] for _ in range(count)]
        for node in range(1, count):
            children[parents[node][0]].append(node)
        queue = deque(children[0])
        while queue:
            node = queue.popleft()
            parent, byte = parents[node]
            if whole[node]:
                self.pops[node] = 1
            elif parent == 0:
                self.pops[node], self.lost[node] = 1, 1
            else:  # what the parent's string pops, then on with what is left of it and this byte
                at, pops, lost = self.fail[parent], self.pops[parent], self.lost[parent]
                while (nxt := self.step.get(at << 8 | byte)) is None:
                    pops, lost, at = pops + self.pops[at], lost + self.lost[at], self.fail[at]
                self.fail[node], self.pops[node], self.lost[node] = nxt, pops, lost
            queue.extend(children[node])

    def _child(self, node: int, byte: int, parents: list, whole: list) -> int:
        key = node << 8 | byte
        if key not in self.step:
            self.step[key] = len(parents)
            parents.append((node, byte))
            whole.append(False)
        return self.step[key]

    def count(self, word: bytes) -> tuple[int, int]:
        """Pieces of a word and how many of them are unknown bytes; each byte is read once."""
        step, fail, pops, lost = self.step.get, self.fail, self.pops, self.lost
        node = pieces = unknown = 0
        for byte in word + bytes([WORD_END]):
            while (nxt := step(node << 8 | byte)) is None:
                pieces += pops[node]
                unknown += lost[node]
                node = fail[node]
            node = nxt
        while node:
            pieces += pops[node]
            unknown += lost[node]
            node = fail[node]
        # A word end that no piece took is not a piece of the text.
        return pieces, unknown


def greedy(pieces: set[bytes], word: bytes) -> tuple[int, int]:
    """What ``Automaton.count`` gives, by building the pieces; for tests."""
    word, at, count, unknown = word + bytes([WORD_END]), 0, 0, 0
    longest = max(map(len, pieces), default=0)
    while at < len(word):
        size = next((n for n in range(min(longest, len(word) - at), 0, -1) if word[at:at + n] in pieces), 0)
        unknown += not size
        count += 1
        at += size or 1
    return count, unknown


def count_tokens(docs: DataFrame, pieces: Iterable[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_words, n_pieces, n_unknown``, a row per row of ``docs``.

    A word whose end no piece takes has its end mark as a last unknown piece.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("data"))
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known = shared.value, {}
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for value in batch.column("data"):
                text = value.as_py()
                words = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
                pieces_, unknown = 0, 0
                for word in words:
                    found = known.get(word)
                    if found is None:
                        found = automaton.count(word)
                        if len(known) < REMEMBERED:
                            known[word] = found
                    pieces_ += found[0]
                    unknown += found[1]
                out.append((len(text), len(words), pieces_, unknown))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([row[k] for row in out], pa.int64()) for k in range(4))],
                ["id", "n_bytes", "n_words", "n_pieces", "n_unknown"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_words long, n_pieces long, n_unknown long")


def op8_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    out = count_tokens(table(spark, sf_dir, "documents"), load_pieces(vocabulary))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_words", "n_pieces", "n_unknown")
