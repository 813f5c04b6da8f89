"""SentencePiece encoding and decoding with source offsets.

``encode`` normalises every text with the model's compiled character map
(longest matching prefix first), recording for each normalised byte the source
byte range it came from. The library, told not to normalise again, segments
the normalised text, and every piece is projected through the alignment to a
byte span of the source text. No piece of most vocabularies goes on past a word
(this is looked up in the model), so a word is segmented once by each worker
however often it occurs; of a vocabulary with such pieces texts are segmented
whole. Decoding is the library's own.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty text; repeated rows and null ids are kept, a row for each;
columns other than the two named are ignored.
"""

from __future__ import annotations

import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import list_column, map_texts, text_bytes

MARK = "▁".encode()
#: Distinct words whose segmentation a worker keeps; when full, the table starts anew.
KEPT_WORDS = 400_000


class CharacterMap:
    """A compiled character map: a double-array trie of source prefixes whose values are offsets of replacements."""

    def __init__(self, blob: bytes):
        self.units, self.texts = None, b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = struct.unpack(f"<{size // 4}I", blob[4 : 4 + size])
            self.texts = blob[4 + size :]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix of source[at:] in the map, and what stands for it."""
        if self.units is None:
            return None
        units, best, node = self.units, None, 0
        node ^= _jump(units[0])
        for i in range(at, len(source)):
            byte = source[i]
            node ^= byte
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != byte:
                break
            node ^= _jump(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        length, offset = best
        return length, self.texts[offset : self.texts.index(b"\0", offset)]


def _jump(unit: int) -> int:
    return unit >> 10 << (unit >> 6 & 8)


def _char_length(first: int) -> int:
    return 1 if first < 0xC0 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


class Codec:
    """Encodes and decodes as the model's own library does; built once by each worker."""

    def __init__(self, model_path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(model_path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        if not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("word marks must come first in a word")
        kinds = pb.ModelProto.SentencePiece
        if any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        # Texts come normalised, so the segmentation must not do so again.
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.plain = sentencepiece.SentencePieceProcessor(model_file=model_path)
        lengths = []
        for p in proto.pieces:
            kind = p.type
            lengths.append(1 if kind == kinds.BYTE else 0 if kind == kinds.CONTROL else -1 if kind == kinds.UNKNOWN else len(p.piece.encode()))
        self.lengths = np.array(lengths, np.int64)
        self.byte_fallback = proto.trainer_spec.byte_fallback
        texts = [p.piece for p in proto.pieces if p.type == kinds.NORMAL]
        self.by_word = self.byte_fallback and not any(MARK.decode() in x.lstrip(MARK.decode()) for x in texts)
        self.by_line = not any("\n" in x for x in texts)
        self._forget()

    def _forget(self) -> None:
        """Words known, and the ids of all of them laid end to end."""
        self.known: dict[bytes, int] = {}
        self.pool, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def normalise(self, source: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The normalised text with word marks, and for each of its bytes where its source begins and ends."""
        n = len(source)
        if self.map.units is None and not self.squeeze:
            if not source:
                return b"", np.zeros(0, np.int32), np.zeros(0, np.int32)
            out = source.replace(b" ", MARK)
            begins = np.arange(n, dtype=np.int32)
            if len(out) > n:
                begins = np.repeat(begins, np.where(np.frombuffer(source, np.uint8) == 0x20, len(MARK), 1))
            ends = begins + 1
            if self.dummy:
                none = np.zeros(len(MARK), np.int32)
                out, begins, ends = MARK + out, np.concatenate([none, begins]), np.concatenate([none, ends])
            return out, begins, ends
        pieces: list[tuple[bytes, int, int]] = []
        i = 0
        while i < n:
            found = self.map.longest(source, i)
            length, text = found if found else (min(_char_length(source[i]), n - i), None)
            pieces.append((source[i : i + length] if text is None else text, i, i + length))
            i += length
        out, spans = bytearray(), []
        spaced = self.squeeze  # leading spaces go, and of several one stays
        for text, start, end in pieces:
            text = text.lstrip(b" ") if spaced else text
            if text:
                if not out and self.dummy:
                    out += MARK
                    spans += [(start, start)] * len(MARK)
                marked = text.replace(b" ", MARK)
                out += marked
                spans += [(start, end)] * len(marked)
                spaced = self.squeeze and text.endswith(b" ")
        while self.squeeze and out.endswith(MARK):
            del out[-len(MARK) :], spans[-len(MARK) :]
        at = np.array(spans, np.int32).reshape(-1, 2)
        return bytes(out), at[:, 0], at[:, 1]

    def words(self, normal: bytes) -> list[bytes]:
        """A normalised text cut where no piece can go across: before word marks that follow something else, and around line ends."""
        out: list[bytes] = []
        for k, line in enumerate(normal.split(b"\n") if self.by_line else [normal]):
            if k:
                out.append(b"\n")
            first, *rest = line.split(MARK)
            if first:
                out.append(first)
            if b"" not in rest:
                out += [MARK + w for w in rest]
                continue
            marks = b""
            for w in rest:
                marks += MARK
                if w:
                    out.append(marks + w)
                    marks = b""
            if marks:
                out.append(marks)
        return out

    def encode(self, normal: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised texts, laid end to end, and the offsets of the texts."""
        if not self.by_word:
            got = self.model.encode([x.decode() for x in normal], num_threads=1)
            offsets = np.cumsum([0, *map(len, got)])
            return np.fromiter(chain.from_iterable(got), np.int32, offsets[-1]), offsets
        if len(self.known) > KEPT_WORDS:
            self._forget()
        known, cut, bounds = self.known, [], [0]
        for x in normal:
            cut += self.words(x)
            bounds.append(len(cut))
        number, new = list(map(known.get, cut)), []
        for i in [i for i, k in enumerate(number) if k is None]:
            number[i] = known.setdefault(cut[i], len(known))
            if number[i] == len(self.sizes) + len(new):
                new.append(cut[i])
        if new:
            got = self.model.encode([w.decode() for w in new], num_threads=1)
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(got), np.int32, sizes.sum())])
        number = np.array(number, np.int64)
        sizes = self.sizes[number]
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.starts[number] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.pool[at], ends[bounds]

    def spans(self, ids: np.ndarray, offsets: np.ndarray, normal: list[tuple[bytes, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """First and last source byte (exclusive) of each piece of texts laid end to end; normal as ``normalise`` gives it."""
        lengths = self.lengths[ids]
        if not self.byte_fallback and (lengths < 0).any():  # an unknown piece may stand for several characters
            each = [self.model.encode(x.decode(), return_type="proto").pieces for x, *_ in normal]
            lengths = np.array([len(p.surface.encode()) for pieces in each for p in pieces], np.int64)
        begins, ends = (np.concatenate([n[k] for n in normal] or [np.zeros(0, np.int32)]) for k in (1, 2))
        stop = np.cumsum(lengths)
        return begins[stop - lengths], ends[stop - 1]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """What the library decodes each text's ids to."""
        flat, cuts = ids.tolist(), offsets.tolist()
        return self.plain.decode([flat[a:b] for a, b in zip(cuts, cuts[1:])], num_threads=1)


def _codec(model_path: str) -> Codec:
    if model_path not in _BUILT:
        _BUILT[model_path] = Codec(model_path)
    return _BUILT[model_path]


_BUILT: dict[str, Codec] = {}


def encode(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = True, decoded: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """id, ids array<int>, with spans begins and ends array<int> (each piece's byte span in the source text), with decoded the text that the ids decode to; then the columns named in ``also``.

    model_path is a file that each executor has, as the library's own data files are.
    """

    def work(batches):
        codec = _codec(model_path)
        for batch in batches:
            normal = [codec.normalise(x) for x in batch.column("text").to_pylist()]
            flat, offsets = codec.encode([x[0] for x in normal])
            columns = [batch.column("id"), list_column(flat, offsets, pa.int32())]
            if spans:
                columns += [list_column(x, offsets, pa.int32()) for x in codec.spans(flat, offsets, normal)]
            if decoded:
                columns.append(pa.array(codec.decode(flat, offsets), pa.string()))
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(f"also{k}") for k in range(len(also)))], names)

    kinds = dict(df.dtypes)
    names = ["id", "ids", *["begins", "ends"][: 2 * spans], *["decoded"][:decoded], *(f"also{k}" for k in range(len(also)))]
    schema = f"id {kinds[id_col]}, ids array<int>" + ", begins array<int>, ends array<int>" * spans + ", decoded string" * decoded + "".join(f", also{k} {kinds[c]}" for k, c in enumerate(also))
    given = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), *(F.col(c).alias(f"also{k}") for k, c in enumerate(also)))
    return map_texts(given, work, schema).withColumnsRenamed({"id": id_col, **{f"also{k}": c for k, c in enumerate(also)}})


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """df with the text that its ids decode to; null ids count as none."""

    def work(batches):
        codec = _codec(model_path)
        for batch in batches:
            k = batch.schema.get_field_index(ids_col)
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column(k).fill_null([])
                sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
                texts = codec.decode(lists.flatten().to_numpy(), np.append(0, np.cumsum(sizes)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out_col])

    fields = [f"`{c}` {t}" for c, t in df.drop(out_col).dtypes]
    return df.drop(out_col).mapInArrow(work, ", ".join([*fields, f"`{out_col}` string"]))
