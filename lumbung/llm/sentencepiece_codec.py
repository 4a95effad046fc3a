"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

A text gets a blank in front and falls into units: a run of blanks with the word after it (the
blank is the word mark). Pieces hold blanks only at their start, so the best segmentation of a text
is that of its units, joined. Per task, the distinct units of a batch that are not known yet are
sorted, which lays them out as a depth-first walk of their trie; a unit keeps the forward scores of
the prefix it has in common with the one before it and searches on from there. Results are kept in
a dictionary of bounded size, so no shuffle is needed and memory does not grow with the data.

Scores are the model's, summed exactly; of equal sums the one whose last piece is longer wins. A
character without a piece becomes its UTF-8 bytes' pieces. The mark itself (U+2581) in a text is
treated as such a character, so decoding gives back every text exactly.

Edge cases: null text has null ids, empty text none; repeated rows are encoded alike; a word of any
length is one unit; an empty table gives an empty result; other columns are kept by ``encode``.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KNOWN = 300_000
SCORE = ""  # the key of a piece's score in its trie node
UNKNOWN_PENALTY = 10.0
_NORMAL, _BYTE = 1, 6


class Codec:
    """A model's pieces with their scores; encodes units and decodes ids."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_ = [0] * 256
        self.table: list[bytes] = []
        for i, piece in enumerate(proto.pieces):
            text = piece.piece.replace(MARK, " ")
            if piece.type == _BYTE:
                self.bytes_[int(piece.piece[1:-1], 16)] = i
                self.table.append(bytes([int(piece.piece[1:-1], 16)]))
            elif piece.type == _NORMAL:
                self.ids[text], self.scores[text] = i, piece.score
                self.table.append(text.encode())
            else:
                self.table.append(b"")
        if any(" " in p.lstrip(" ") for p in self.ids):
            raise ValueError("a piece has a blank after another character; units would cut it")
        self.longest = max(map(len, self.ids))
        self.trie: dict = {}
        for text, score in self.scores.items():
            node = self.trie
            for char in text:
                node = node.setdefault(char, {})
            node[SCORE] = score
        self.lengths = np.array([len(t) for t in self.table])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(self.table), np.uint8)
        self.unknown = min(self.scores.values()) - UNKNOWN_PENALTY
        # A line feed that is in no piece of several characters cuts units too.
        apart = not any("\n" in p and len(p) > 1 for p in self.ids)
        self.pattern = re.compile(r" *[^ \n]+| +|\n" if apart else r" *[^ ]+| +")
        self.known: dict[str, bytes] = {}

    def walk(self, units: list[str]):
        """(unit, ids) of sorted distinct units, with forward scores shared along common prefixes."""
        trie, longest, unknown = self.trie, self.longest, self.unknown
        best, back, before = [0.0], [0], ""
        for unit in units:
            size, same, most = len(unit), 0, min(len(unit), len(before))
            while same < most and unit[same] == before[same]:
                same += 1
            # Ends up to the common prefix are final; pieces that begin before it may end beyond it.
            best[same + 1 :] = [None] * (size - same)
            back[same + 1 :] = [0] * (size - same)
            for begin in range(max(0, same + 1 - longest), size):
                score, node, end = best[begin], trie, begin
                while end < size and (node := node.get(unit[end])) is not None:
                    end += 1
                    piece = node.get(SCORE)
                    if piece is not None and end > same:
                        piece += score
                        if best[end] is None or piece > best[end]:
                            best[end], back[end] = piece, begin
                if begin >= same and unit[begin] not in self.ids:
                    piece = score + unknown
                    if best[begin + 1] is None or piece > best[begin + 1]:
                        best[begin + 1], back[begin + 1] = piece, begin
            before, ids, end = unit, [], size
            while end:
                begin = back[end]
                piece = self.ids.get(unit[begin:end])
                if piece is not None:
                    ids.append(piece)
                else:
                    ids += [self.bytes_[b] for b in reversed(unit[begin:end].encode())]
                end = begin
            ids.reverse()
            yield unit, ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as the bytes of 32-bit numbers."""
        cut = [self.pattern.findall(" " + t) if t else [] for t in texts]
        if len(self.known) > KNOWN:
            self.known.clear()
        new = {u for units in cut for u in units}
        new.difference_update(self.known)
        known = self.known
        for unit, ids in self.walk(sorted(new)):
            known[unit] = array("i", ids).tobytes()
        return [b"".join([known[u] for u in units]) for units in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of encoded ids."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.letters[at][1:].tobytes()


def load(path: str = MODEL) -> Codec:
    with open(path, "rb") as file:  # a file of the installation, read on the driver and sent with the task
        return Codec(file.read())


def _encode(codec: Codec, keep: int, check: bool):
    def run(batches):
        for batch in batches:
            texts = batch.column("_text")
            for row, _, offsets in pieces(texts.fill_null("")):
                part = batch.slice(row, len(offsets) - 1)
                raw = part.column("_text").to_pylist()
                encoded = codec.encode_all([t or "" for t in raw])
                sizes = np.cumsum([0, *(len(e) // 4 for e in encoded)]).astype(np.int32)
                values, null = np.frombuffer(b"".join(encoded), np.int32), pa.array([t is None for t in raw])
                out = {"ids": pa.ListArray.from_arrays(pa.array(sizes), pa.array(values), mask=null)}
                if check:
                    out["round_trip"] = pa.array(
                        [None if t is None else codec.decode(values[a:b]) == t.encode() for t, a, b in zip(raw, sizes, sizes[1:])], pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns[:keep], *out.values()], names=[*part.schema.names[:keep], *out])

    return run


def encode(docs: DataFrame, codec: Codec, *keep: str, check: bool = False) -> DataFrame:
    """The kept columns and ``ids`` (array of int) of ``text``; with ``check`` also whether decoding them gives the text again."""
    taken = docs.select(*keep, F.col("text").alias("_text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1]]
    return taken.mapInArrow(_encode(codec, len(keep), check), ", ".join([*fields, "ids array<int>", *["round_trip boolean"] * check]))


def _decode(codec: Codec, keep: int):
    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                part = batch.slice(i, 1)
                ids = part.column("_ids")[0]
                text = codec.decode(ids.values.to_numpy()).decode("utf-8", "replace") if ids.is_valid else None
                yield pa.RecordBatch.from_arrays([*part.columns[:keep], pa.array([text], pa.string())], names=[*part.schema.names[:keep], "text"])

    return run


def decode(encoded: DataFrame, codec: Codec, *keep: str) -> DataFrame:
    """The kept columns and ``text`` of ``ids``; bytes that are not UTF-8 become U+FFFD."""
    taken = encoded.select(*keep, F.col("ids").alias("_ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1]]
    return taken.mapInArrow(_decode(codec, len(keep)), ", ".join([*fields, "text string"]))


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id, n_tokens, ids, and whether decoding the ids gives the text again (null for null)."""
    encoded = encode(docs.select("doc_id", "text"), load(path), "doc_id", check=True)
    return encoded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")
