"""SentencePiece encoding by a Viterbi search that shares common prefixes.

A text is marked as the library does it (a space in front, spaces written as
U+2581) and cut into marked words: runs of marks with the characters up to the
next mark or line break. No piece of the vocabulary crosses such a cut, which
is checked when the model is read, so the best segmentation of the text is the
words' best segmentations one after another.

A task takes the distinct marked words of a slice of texts, sorts them and
walks them depth-first as a trie: forward scores, back pointers and the active
piece prefixes of a word's first characters are those of the word before it up
to their common prefix, so each trie node is scored once. The segmentation with
the largest sum of piece scores wins; of ties the one whose last piece starts
first, position by position, which is the library's unigram rule. Characters
outside the vocabulary become byte pieces. The given model file was made for
pair merging, so its scores are negated merge ranks; they are used as they are.

Null text gives null ids; empty text gives no ids. Texts are encoded whole; a
word may be as long as its text.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm import flat
from tavola.llm.common import map_arrow, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 200_000
_models: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Piece scores as a character trie, and the bytes of every piece."""

    def __init__(self, proto: bytes):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = sp.get_piece_size()
        pieces = sp.id_to_piece(list(range(n)))
        scores = sp.get_score(list(range(n)))
        self.byte_ids = [0] * 256
        self.trie: dict = {}
        surface = []
        lowest = 0.0
        for i, (piece, score) in enumerate(zip(pieces, scores)):
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                surface.append(bytes([value]))
                continue
            if sp.is_control(i) or sp.is_unknown(i):
                surface.append(b"")
                continue
            if MARK in piece.lstrip(MARK) or "\n" in piece:
                raise ValueError(f"piece {piece!r} crosses a word cut")
            surface.append(piece.replace(MARK, " ").encode())
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (score, i)
            if score > -1e8:
                lowest = min(lowest, score)
        self.unknown = lowest - 10.0
        self.size = np.array([len(s) for s in surface], dtype=np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(surface), dtype=np.uint8)

    @staticmethod
    def of(proto: bytes) -> "Vocabulary":
        key = hashlib.sha1(proto).hexdigest()
        if key not in _models:
            _models[key] = Vocabulary(proto)
        return _models[key]

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of every word of a sorted list, with one depth-first walk."""
        best, back, live = [0.0], [None], [()]
        trie, unknown, out, before = self.trie, self.unknown, [], ""
        for word in words:
            shared, n = 0, min(len(word), len(before))
            while shared < n and word[shared] == before[shared]:
                shared += 1
            del best[shared + 1:], back[shared + 1:], live[shared + 1:]
            for d in range(shared, len(word)):
                c = word[d]
                top, link, going = None, None, []
                for start, node in (*live[d], (d, trie)):
                    node = node.get(c)
                    if node is not None:
                        going.append((start, node))
                        end = node.get("")
                        if end is not None and (top is None or best[start] + end[0] > top):
                            top, link = best[start] + end[0], (start, end[1])
                if link is None or link[0] != d and trie.get(c, {}).get("") is None:
                    score = best[d] + unknown
                    if top is None or score > top:
                        top, link = score, (d, -1)
                best.append(top)
                back.append(link)
                live.append(going)
            ids, at = [], len(word)
            while at:
                start, i = back[at]
                if i < 0:
                    ids.extend(self.byte_ids[b] for b in reversed(word[start:at].encode()))
                else:
                    ids.append(i)
                at = start
            ids.reverse()
            out.append(ids)
            before = word
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and bounds of the texts whose ids lie between ``bounds``."""
        size = self.size[ids]
        ends = np.r_[0, np.cumsum(size)]
        pick = np.repeat(self.start[ids] - ends[:-1], size) + np.arange(ends[-1])
        data, cut = self.bytes[pick], ends[bounds]
        first = cut[:-1][np.diff(cut) > 0]  # the mark that encoding put in front
        first = first[data[first] == 0x20]
        return np.delete(data, first), cut - np.searchsorted(first, cut)


def _units(data: np.ndarray, offsets: np.ndarray):
    """Bounds of marked words; a row's first word carries the added mark."""
    space, line = data == 0x20, data == 0x0A
    head = np.zeros(len(data), dtype=bool)
    head[1:] = (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    lead = np.zeros(len(data), dtype=bool)
    lead[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(head | lead)
    return start, np.r_[start[1:], len(data)].astype(np.int64), lead[start]


def _encode_slice(vocab: Vocabulary, known: dict, data: np.ndarray, offsets: np.ndarray):
    """Ids of all texts of a slice and the bounds of each text's ids."""
    start, end, lead = _units(data, offsets)
    code = flat.Rolling(flat.BYTE_CODE[data], "byte").ranges(start, end) ^ lead.astype(np.uint64)
    codes, at, inverse = np.unique(code, return_index=True, return_inverse=True)
    raw = data.tobytes()
    todo = {}
    listed = codes.tolist()
    for c, s, e, first in zip(listed, start[at].tolist(), end[at].tolist(), lead[at].tolist()):
        if c not in known:
            todo[c] = (MARK if first else "") + raw[s:e].decode("utf-8", "replace").replace(" ", MARK)
    if len(known) + len(todo) > REMEMBERED:
        wanted = set(listed)
        for c in [c for c in known if c not in wanted]:
            del known[c]
    order = sorted(todo, key=todo.get)
    known.update((c, array("i", ids).tobytes()) for c, ids in zip(order, vocab.encode_sorted([todo[c] for c in order])))
    lists = [known[c] for c in listed]
    size = np.array([len(x) for x in lists], dtype=np.int64) // 4
    pool = np.frombuffer(b"".join(lists), dtype=np.int32)
    begin = np.cumsum(size) - size
    n = size[inverse]
    ends = np.r_[0, np.cumsum(n)]
    ids = pool[np.repeat(begin[inverse] - ends[:-1], n) + np.arange(ends[-1])]
    bounds = ends[np.searchsorted(start, offsets)]
    return ids, bounds


def encode(docs: DataFrame, model: str = MODEL, decoded: bool = False) -> DataFrame:
    """doc_id, ids, n_ids, round_trip (decoding the ids gives the text) per input row; text with ``decoded``."""
    spark = docs.sparkSession
    proto = bytes(spark.read.format("binaryFile").load(model).first()["content"])
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def fn(batch: pa.RecordBatch):
        vocab = Vocabulary.of(proto)
        known = vocab.__dict__.setdefault("known", {})
        column = batch.column("text")
        for a, b, data, offsets in flat.chunks(column):
            ids, bounds = _encode_slice(vocab, known, data, offsets)
            back, cut = vocab.decode(ids, bounds)
            if len(back) == len(data) and np.array_equal(cut, offsets) and np.array_equal(back, data):
                same = np.ones(b - a, dtype=bool)
            else:
                same = np.array([np.array_equal(back[cut[i]:cut[i + 1]], data[offsets[i]:offsets[i + 1]])
                                 for i in range(b - a)])
            null = column.slice(a, b - a).is_null()
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()),
                                              mask=null if null.true_count else None)
            cols = {"doc_id": batch.column("doc_id").slice(a, b - a), "ids": listed,
                    "n_ids": np.diff(bounds), "round_trip": pa.array(same)}
            if decoded:
                raw, bad = back.tobytes(), null.to_pylist()
                cols["text"] = [None if bad[i] else raw[cut[i]:cut[i + 1]].decode("utf-8", "replace") for i in range(b - a)]
            yield cols

    return map_arrow(docs, fn, "doc_id long, ids array<int>, n_ids long, round_trip boolean" + ", text string" * decoded)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id, text of rows (doc_id, ids); null ids give null, ids are decoded as the library does."""
    spark = encoded.sparkSession
    proto = bytes(spark.read.format("binaryFile").load(model).first()["content"])

    def fn(batch: pa.RecordBatch):
        vocab = Vocabulary.of(proto)
        column = batch.column("ids")
        bounds = column.fill_null([]).offsets.to_numpy().astype(np.int64)
        ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        data, cut = vocab.decode(ids, bounds - bounds[0])
        raw = data.tobytes()
        null = column.is_null().to_pylist()
        yield {"doc_id": batch.column("doc_id"),
               "text": [None if x else raw[cut[i]:cut[i + 1]].decode("utf-8", "replace") for i, x in enumerate(null)]}

    return map_arrow(encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), fn,
                     "doc_id long, text string")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"))
