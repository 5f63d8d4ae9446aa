"""N-best SentencePiece segmentation, and decoding.

The piece lattice of a text has an edge for every vocabulary piece that
stands at a place, and one of bytes for a character that is no piece.
Forward Viterbi gives every place the best score of reaching it.  A search
from the end of the text back to its beginning uses these scores as its A*
heuristic; as they are exact, complete paths leave the queue in the order of
their scores, and the first N are the N best.  Scores are whole numbers of
``UNIT``, so that paths of equal scores tie exactly; of these the one closest
to its end goes on first, and no more than about N times a path's length of
places are ever visited.

No piece goes on across the space in front of a word, so the lattice is a
chain of word lattices.  Only the N - 1 words whose second best path loses
least can differ from their best path in the N best of the text: any other
word's change could be swapped for an unused change that loses no more.  The
text's search therefore runs over these words alone, each with its own N best
paths, found by the same search in the word's lattice.

Unigram models bring log probabilities.  BPE models bring merge ranks, which
are turned into log probabilities by Zipf's law, -ln(rank + 1).

Decoding joins the pieces and takes off the space put before the text, so
every text comes back as it was; a literal U+2581, which the plain library
turns into a space, is written as bytes.

Null text counts as empty and has no pieces.  Paths of equal scores have a
fixed order.  Equal rows and null ids are kept, extra columns are ignored.
"""
from __future__ import annotations

import heapq
import math
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N_BEST = 4
#: Distinct words one Python worker remembers.
CACHE_WORDS = 1_600_000
SPACE = "▁"
UNIT = 1e-4
_WORD = re.compile(r" +[^ ]*")

#: Below any score.
NONE = -(1 << 62)


def search(n_places: int, into: list[list[tuple[int, int, tuple]]], forward: list[int],
           n: int) -> list[tuple[int, tuple]]:
    """The ``n`` best paths from place 0 to the last one.  ``into[j]``: the
    edges (from, score, label) that end at j, in order of preference."""
    queue, made, found = [(-forward[-1], n_places - 1, 0, 0, None)], 0, []
    while queue and len(found) < n:
        _, place, _, score, path = heapq.heappop(queue)
        if place == 0:
            labels = []
            while path is not None:
                labels.append(path[0])
                path = path[1]
            found.append((score, tuple(labels)))
            continue
        for start, s, label in into[place]:
            if forward[start] > NONE:
                made += 1
                heapq.heappush(queue, (-(score + s + forward[start]), start, made, score + s, (label, path)))
    return found


class Segmenter:
    def __init__(self, model_file: str, n_best: int = N_BEST):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.n_best = n_best
        scores = [model.get_score(i) for i in range(model.vocab_size())]
        ranked = all(s == int(s) for s in scores)
        self.bytes_of: list[bytes] = []
        self._byte_ids = [0] * 256
        #: piece or beginning of one -> score (below 0), or None for a mere beginning
        self._score: dict[str, int | None] = {}
        self._id: dict[str, int] = {}
        for i, s in enumerate(scores):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self._byte_ids[int(piece[3:-1], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:-1], 16)]))
                continue
            text = piece.replace(SPACE, " ")
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
                continue
            if " " in text.lstrip(" "):
                raise ValueError(f"piece {piece!r} spans words")
            self.bytes_of.append(text.encode())
            for k in range(1, len(text)):
                self._score.setdefault(text[:k], None)
            self._score[text] = min(round((-math.log(1 - s) if ranked else s) / UNIT), -1)
            self._id[text] = i
        #: letter -> (the same for the letters that may follow, score of the piece up to here or None)
        self._tree: dict[str, tuple[dict, int | None]] = {}
        for piece in sorted(self._score, key=len):
            node = self._tree
            for c in piece[:-1]:
                node = node[c][0]
            node[piece[-1]] = ({}, self._score[piece])
        self._alone = {x for x in self._id if len(x) == 1}
        #: letter and stop that stand together inside some piece
        self._joined = {x for piece in self._id for x in re.findall(r"(?=([^\W\d_][.,]))", piece)}
        self._byte_score = min(x for x in self._score.values() if x) - round(10 / UNIT)
        self._best: dict[str, tuple[bytes, int, int]] = {}
        self._older: dict[str, tuple[bytes, int, int]] = {}
        self._paths: dict[str, list[tuple[int, bytes]]] = {}

    def edges(self, word: str) -> list[tuple[int, int, int, tuple[int, ...]]]:
        """(from, to, score, ids) of a word's lattice, by falling length from
        each place."""
        out, size = [], len(word)
        for i in range(size):
            here = []
            for j in range(i + 1, size + 1):
                s = self._score.get(word[i:j], False)
                if s is False:
                    break
                if s is not None:
                    here.append((i, j, s, (self._id[word[i:j]],)))
            if word[i] not in self._alone:
                ids = tuple(self._byte_ids[b] for b in word[i].encode())
                here.insert(0, (i, i + 1, self._byte_score * len(ids), ids))
            out += reversed(here)
        return out

    def _word(self, word: str) -> tuple[bytes, int, int]:
        """Ids and score of a word's best path, and what its second best loses
        (forward Viterbi that keeps the two best scores of every place)."""
        # a stop or comma behind a letter mostly begins a piece, so the word without it may be known
        if word[-1] in ".," and (core := word.rstrip(".,"))[-1:].isalpha() \
                and word[len(core) - 1:len(core) + 1] not in self._joined:
            (ids, score, loss), tail = self.word(core), self.word(word[len(core):])
            return ids + tail[0], score + tail[1], min(loss, tail[2])
        tree, size, alone = self._tree, len(word), self._alone
        first, second = [NONE] * (size + 1), [NONE] * (size + 1)
        first[0] = 0
        start_of = [0] * (size + 1)
        for i in range(size):
            here, here2 = first[i], second[i]
            if word[i] not in alone:
                s = self._byte_score * len(word[i].encode())
                if here + s > first[i + 1]:
                    second[i + 1] = max(first[i + 1], here2 + s)
                    first[i + 1], start_of[i + 1] = here + s, i
                elif here + s > second[i + 1]:
                    second[i + 1] = here + s
            node, j = tree, i
            for c in word[i:]:
                if (step := node.get(c)) is None:
                    break
                node, s = step
                j += 1
                if s is not None:
                    v = here + s
                    if v > (old := first[j]):
                        v2 = here2 + s
                        second[j] = old if old > v2 else v2
                        first[j], start_of[j] = v, i
                    elif v > second[j]:
                        second[j] = v
        ids, end = [], size
        while end:
            i = start_of[end]
            if (piece := self._id.get(word[i:end])) is None:
                ids += [self._byte_ids[b] for b in reversed(word[i].encode())]
            else:
                ids.append(piece)
            end = i
        ids.reverse()
        return _bytes(ids), first[size], first[size] - second[size]

    def word(self, word: str) -> tuple[bytes, int, int]:
        if (known := self._best.get(word)) is None:
            if len(self._best) >= CACHE_WORDS // 2:      # words not met since the last time are forgotten
                self._older = dict(self._best)
                self._best.clear()
            known = self._older.get(word) or self._word(word)
            self._best[word] = known
        return known

    def paths(self, word: str) -> list[tuple[int, bytes]]:
        """A word's N best paths."""
        if (known := self._paths.get(word)) is None:
            if len(self._paths) >= CACHE_WORDS // 20:
                self._paths.clear()
            into: list[list] = [[] for _ in range(len(word) + 1)]
            forward = [0] + [NONE] * len(word)
            for i, j, s, ids in self.edges(word):
                into[j].append((i, s, ids))
                forward[j] = max(forward[j], forward[i] + s)
            known = self._paths[word] = [
                (s, _bytes([x for part in labels for x in part]))
                for s, labels in search(len(word) + 1, into, forward, self.n_best)]
        return known

    def encode(self, text: str) -> list[tuple[float, bytes]]:
        """The N best segmentations (score, ids as little-endian bytes)."""
        if not text:
            return [(0.0, b"")]
        if "  " in text or text[0] == " " or text[-1] == " ":
            words = _WORD.findall(" " + text)
        else:
            words = [" " + w for w in text.split(" ")]
        get = self._best.get
        known = [get(w) or self.word(w) for w in words]
        total = sum([k[1] for k in known])
        losses = [k[2] for k in known]
        ids = [k[0] for k in known]
        # the words with the smallest losses, in text order, are the places of a small lattice
        free = sorted(heapq.nsmallest(self.n_best - 1, range(len(words)), key=losses.__getitem__))
        free = [w for w in free if losses[w] < -NONE // 2]
        into = [[]] + [[(k, s - known[w][1], (w, p)) for s, p in self.paths(words[w])] for k, w in enumerate(free)]
        out = []
        for loss, labels in search(len(free) + 1, into, [0] * (len(free) + 1), self.n_best):
            for w, p in labels:
                ids[w] = p
            out.append(((total + loss) * UNIT, b"".join(ids)))
        return out

    def decode(self, ids: bytes) -> str:
        if not ids:
            return ""
        values = array("I", ids)
        if sys.byteorder == "big":
            values.byteswap()
        return b"".join(map(self.bytes_of.__getitem__, values)).decode()[1:]


def _bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def encode_nbest(docs: DataFrame, model_file: str, n_best: int = N_BEST, with_ids: bool = False) -> DataFrame:
    """doc_id, text_ok (the best path decodes to the text) and ``paths``:
    (score, n_pieces, ids_crc32) of the N best, best first; with ``with_ids``
    also the ids of each as little-endian bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = None
        fields = [("score", pa.float64()), ("n_pieces", pa.int64()), ("ids_crc32", pa.int64())]
        fields += [("ids", pa.binary())] * with_ids
        for batch in batches:
            segmenter = segmenter or Segmenter(model_file, n_best)
            ok, paths = [], []
            for t in batch.column(1):
                text = t.as_py() or ""
                best = segmenter.encode(text)
                ok.append(segmenter.decode(best[0][1]) == text)
                paths.append([{"score": s, "n_pieces": len(x) // 4, "ids_crc32": zlib.crc32(x)}
                              | ({"ids": x} if with_ids else {}) for s, x in best])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ok, pa.bool_()), pa.array(paths, pa.list_(pa.struct(fields)))],
                names=["doc_id", "text_ok", "paths"])

    path = "score: double, n_pieces: bigint, ids_crc32: bigint" + (", ids: binary" if with_ids else "")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id long, text_ok boolean, paths array<struct<{path}>>")


def decode(encoded: DataFrame, model_file: str, ids: str = "ids") -> DataFrame:
    """``doc_id`` and the ``text`` of a column of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = None
        for batch in batches:
            segmenter = segmenter or Segmenter(model_file)
            texts = [segmenter.decode(x.as_py() or b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", ids).mapInArrow(run, "doc_id long, text string")


def op3(docs: DataFrame, model_file: str) -> DataFrame:
    best = F.col("paths")[0]
    return encode_nbest(docs, model_file).select(
        "doc_id", "text_ok", F.size("paths").alias("n_paths"), best["score"].alias("score"),
        best["n_pieces"].alias("n_pieces"), best["ids_crc32"].alias("ids_crc32"), "paths")
