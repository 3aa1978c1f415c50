"""SentencePiece encoding that keeps offsets, and decoding.

The text is normalized by longest prefixes of the model's compiled character map, and every normalized byte
remembers the source byte it came from. Pieces are laid end to end over the normalized bytes and projected
through that alignment, so each id has a byte span in the original text and the spans of a text join up.

Merging is the library's. Where no piece has a word boundary inside it, no merge crosses one, so words are
encoded apart and each different one only once per task, which gives the ids of the whole text. Other models,
and texts that hold the boundary sign itself, are encoded whole.

Rows: a NULL text is an empty one. An empty text has the begin and end ids alone, with empty spans. Repeated
rows are encoded each. Other columns of the input are not read.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import id_and_bytes

SIGN = "\u2581"
# Different words whose ids a task remembers.
REMEMBERED = 300_000
SCHEMA = "doc_id long, ids binary, begins binary, ends binary, decoded string"


class CharacterMap:
    """The compiled map of a model: a double array of prefixes, then their replacements, each ended by zero."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.replacements = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """Replacement of the longest prefix at a place and its length, None if the map has none."""
        if not self.units:
            return None
        place, found = self._below(0), None
        for taken, byte in enumerate(text[at:], 1):
            place ^= byte
            unit = self.units[place] if place < len(self.units) else 0
            if unit & 0x800000FF != byte:
                break
            place ^= self._offset(unit)
            if unit >> 8 & 1:
                start = self.units[place] & 0x7FFFFFFF
                found = self.replacements[start : self.replacements.index(0, start)], taken
        return found

    def _below(self, node: int) -> int:
        return node ^ self._offset(self.units[node])

    @staticmethod
    def _offset(unit: int) -> int:
        return unit >> 10 << ((unit & 0x200) >> 6)


class Codec:
    """One model: encodes and decodes a text, and tells where each id came from."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as messages

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = messages.ModelProto()
        model.ParseFromString(self.processor.serialized_model_proto())
        self.spec = model.normalizer_spec
        self.map = CharacterMap(self.spec.precompiled_charsmap)
        self.suffix = model.trainer_spec.treat_whitespace_as_suffix
        self.pieces = [p.piece for p in model.pieces]
        kinds = np.array([p.type for p in model.pieces])
        self.is_byte = kinds == 6
        self.unknown = int(np.flatnonzero(kinds == 2)[0])
        own = any(re.search(f"[^{SIGN}]{SIGN}", p) for p in self.pieces) or bool((kinds == 4).any())
        spec = self.spec
        self.by_word = (
            not (own or self.suffix or spec.precompiled_charsmap or spec.remove_extra_whitespaces)
            and spec.add_dummy_prefix and spec.escape_whitespaces and self.is_byte.any()
        )
        # Source bytes of each piece where the map changes nothing: the sign stands for one space.
        self.source_bytes = np.array([1 if b else len(p.replace(SIGN, " ").encode()) for p, b in zip(self.pieces, self.is_byte)])

    @cached_property
    def words(self) -> dict[str, bytes]:
        encode, processor = np.array, self.processor

        class Words(dict):
            def __missing__(self, word: str) -> bytes:
                ids = encode(processor.encode(word), dtype="<u4").tobytes()
                if len(self) < REMEMBERED:
                    self[word] = ids
                return ids

        return Words()

    def normalized(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalized bytes, and for each of them and for the end the source byte at which it begins."""
        spec, out, origin = self.spec, bytearray(), []
        space = SIGN.encode() if spec.escape_whitespaces else b" "

        def put(piece: bytes, at: int) -> None:
            out.extend(piece)
            origin.extend([at] * len(piece))

        at, pieces = 0, []
        while at < len(text):
            found = self.map.longest(text, at)
            if found is None:
                width = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                found = text[at : at + width], width
            pieces.append((found[0], at))
            at += found[1]
        if spec.remove_extra_whitespaces:
            while pieces and pieces[0][0] == b" ":
                pieces.pop(0)
        if not pieces:
            return b"", np.array([0])
        if spec.add_dummy_prefix and not self.suffix:
            put(space, pieces[0][1])
        blank = spec.remove_extra_whitespaces
        for piece, start in pieces:
            if blank:
                piece = piece.lstrip(b" ")
            put(piece.replace(b" ", space), start)
            if piece:
                blank = spec.remove_extra_whitespaces and piece.endswith(b" ")
        end = len(text)
        if spec.remove_extra_whitespaces:
            while out.endswith(space):
                end = origin[-len(space)]
                del out[-len(space) :], origin[-len(space) :]
        if spec.add_dummy_prefix and self.suffix:
            put(space, end)
        return bytes(out), np.array(origin + [end])

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids without begin and end, and the first and past-the-last source byte of each."""
        if not self.by_word or SIGN in text:
            return self._encode_whole(text)
        if not text:
            none = np.zeros(0, np.int64)
            return none.astype("<u4"), none, none
        ids = np.frombuffer(b"".join(map(self.words.__getitem__, split_words(text))), "<u4")
        ends = np.cumsum(self.source_bytes[ids]) - 1  # the sign before the text stands for nothing
        begins = np.concatenate([[0], ends[:-1]])
        return ids, begins, ends

    def _encode_whole(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.array(self.processor.encode(text), dtype="<u4")
        raw = text.encode()
        normal, origin = self.normalized(raw)
        surfaces = self.processor.encode(text, out_type=str)
        lengths = [1 if self.is_byte[i] else len(s.encode()) for i, s in zip(ids, surfaces)]
        edges = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        if edges[-1] != len(normal):
            raise ValueError("the pieces do not cover the normalized text")
        at = origin[edges]
        return ids, at[:-1], at[1:]


def split_words(text: str) -> list[str]:
    """The text cut before every run of spaces; each part is what the library has to be given for it.

    The library puts a sign before what it encodes, so a part drops the first space of its run. Spaces at the
    end stay with the last word: the library gives nothing for an empty part.
    """
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    parts = re.findall(r" *[^ ]+(?: +\Z)?| +", " " + text)
    return [p[1:] for p in parts]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, begins, ends, decoded) per row.

    ``ids`` are little-endian unsigned 32-bit integers with the begin and end ids; ``begins`` and ``ends`` are
    the byte spans of all ids in the original text, likewise; ``decoded`` is the library's text of the ids.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path)
        begin, end = codec.processor.bos_id(), codec.processor.eos_id()
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = (value.as_py() or b"").decode("utf-8", "replace")
                ids, begins, ends = codec.encode(text)
                size = len(text.encode())
                ids = np.concatenate([[begin], ids, [end]]).astype("<u4")
                begins = np.concatenate([[0], begins, [size]]).astype("<u4")
                ends = np.concatenate([[0], ends, [size]]).astype("<u4")
                rows.append((ids.tobytes(), begins.tobytes(), ends.tobytes(), codec.processor.decode(ids.tolist())))
            columns = list(zip(*rows)) or [()] * 4
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.string()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "begins", "ends", "decoded"])

    return id_and_bytes(docs, id_col, text_col).mapInArrow(work, SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of what ``encode_documents`` returns."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
        F.sha2(F.concat("begins", "ends"), 256).alias("spans_sha256"),
    )
