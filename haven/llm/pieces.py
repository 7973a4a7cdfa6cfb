"""Exact merge-type (BPE) piece encoding by backtracking, and decoding.

A text is encoded without ever running its merges.  Pieces come from the
longest matches of an Aho-Corasick automaton over the vocabulary; a piece may
follow another only if re-merging the two together gives the two back, and a
position from which no continuation worked is struck from a bitfield so that it
is never tried again.  The first sequence that reaches the end is the merge
result: a sequence whose adjacent pieces are all compatible is unique.

Pieces with a space mark inside are runs of marks only, so text is cut before
each run of marks and around characters without a piece (written as bytes);
those segments are encoded independently and remembered in a bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Piece types of the model file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class PieceCodec:
    """Encoder and decoder over one vocabulary: ``pieces`` is [(piece, score, type)]."""

    def __init__(self, pieces: list[tuple[str, float, int]], bos: int, eos: int, memory: int = 200_000):
        self.bos, self.eos, self.memory = bos, eos, memory
        self.scores = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == NORMAL}
        self.ids = {p: i for p, (_, i) in self.scores.items()}
        self.text = [p for p, _, _ in pieces]
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == BYTE}
        table = []
        for p, _, kind in pieces:
            table.append(b"" if kind == CONTROL else bytes([int(p[3:5], 16)]) if kind == BYTE
                         else " ⁇ ".encode() if kind == UNKNOWN else p.replace(SPACE, " ").encode())
        self.surface = table
        self.starts_with_space = [p.startswith(SPACE) and kind == NORMAL for p, _, kind in pieces]
        self.invisible = [kind == CONTROL for _, _, kind in pieces]
        self.is_byte = np.array([kind == BYTE for _, _, kind in pieces])
        single = {c for p in self.ids for c in p}
        self.known = {c for c in single if c in self.ids}
        # a segment: a run of space marks with what follows it up to the next run, within known characters
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merge(p) == [p]:  # a piece no merge reaches never appears
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in self.text]
        #: the longest piece that is a proper prefix of a piece, or -1
        self.shorter = [-1] * len(pieces)
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.automaton), -1)
        self.pairs: dict[int, bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.segments = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")

    @classmethod
    def from_file(cls, path: str, memory: int = 200_000) -> PieceCodec:
        from sentencepiece import sentencepiece_model_pb2 as model_pb
        model = model_pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        n, t = model.normalizer_spec, model.trainer_spec
        if t.model_type != 2 or n.precompiled_charsmap or not n.add_dummy_prefix or n.remove_extra_whitespaces \
                or not t.byte_fallback or t.treat_whitespace_as_suffix:
            raise ValueError("a merge-type model with byte fallback and plain normalisation is needed")
        if any(SPACE in p.piece.lstrip(SPACE) or (p.piece.startswith(SPACE * 2) and p.piece.strip(SPACE))
               for p in model.pieces if p.type == NORMAL):
            raise ValueError("a piece joins words: segments would not be independent")
        if any(p.type == USER for p in model.pieces):
            raise ValueError("user-defined pieces are not supported")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], t.bos_id, t.eos_id, memory)

    # -- merging, for short strings only ------------------------------------------
    def merge(self, text: str) -> list[str]:
        """The merge rule itself: join the adjacent pair whose whole has the best
        score, the leftmost of equals, until none is a piece."""
        parts = list(text)
        scores = self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = scores.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s[0] > best):
                    best, at = s[0], i
            if at < 0:
                return parts
            parts[at: at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * self.memory:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            known = self.pairs[key] = self.merge(a + b) == [a, b]
        return known

    # -- encoding -----------------------------------------------------------------
    def _encode_known(self, text: str) -> list[int]:
        """Backtracking over a segment of known characters."""
        n = len(text)
        longest = [0] * n
        for end, (length, piece) in self.automaton.iter(text):
            longest[end - length + 1] = piece  # a start's longer matches end later
        lengths, shorter, pairs = self.lengths, self.shorter, self.pairs
        failed = 0  # bit p: nothing that begins at p worked
        ids: list[int] = []
        pos, piece, last = 0, longest[0], -1
        while True:
            while piece >= 0:
                end = pos + lengths[piece]
                if not failed >> end & 1:
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | piece)
                    if fits or fits is None and self.compatible(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                ids.append(piece)
                if end == n:
                    return ids
                pos, last, piece = end, piece, longest[end]
            else:
                failed |= 1 << pos
                if not ids:
                    raise ValueError("no merge sequence covers the segment")
                piece = ids.pop()
                pos -= lengths[piece]
                piece = shorter[piece]
                last = ids[-1] if ids else -1

    def _encode_segment(self, segment: str) -> list[int]:
        out: list[int] = []
        start = 0
        for i, c in enumerate(segment):
            if c not in self.known:
                if i > start:
                    out += self._encode_run(segment[start:i])
                out += [self.byte_ids[b] for b in c.encode()]
                start = i + 1
        if start < len(segment):
            out += self._encode_run(segment[start:])
        return out

    def _encode_run(self, text: str, block: int = 4096) -> list[int]:
        """Very long runs without a space go block by block.

        An encoding is right exactly when every two neighbouring pieces are
        compatible.  Those inside a block are by construction; the pair that is
        joined at a seam is tested, and where it fails, pieces before the seam
        are taken back and encoded with what follows, ever more of them.
        """
        out: list[int] = []
        at, view, back = 0, 2 * block, 1
        while True:
            ids = self._encode_known(text[at: at + view])
            if out and not self.compatible(out[-1], ids[0]):
                take = out[-back:]
                del out[-back:]
                n = sum(len(self.text[i]) for i in take)
                at, view, back = at - n, view + n, 2 * back
                continue
            if at + view >= len(text):
                return out + ids
            done = 0
            for keep, i in enumerate(ids):  # all but the last block is kept, so every round gets further
                if keep and done + len(self.text[i]) > view - block:
                    break
                done += len(self.text[i])
            else:
                keep = len(ids)
            out += ids[:keep]
            at, view, back = at + done, 2 * block, 1

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, begin and end included."""
        out = [self.bos.to_bytes(4, "little")]
        if text:
            young, old = self.young, self.old
            for segment in self.segments.findall(SPACE + text.replace(" ", SPACE)):
                code = young.get(segment)
                if code is None:
                    code = old.get(segment)
                    if code is None:
                        code = np.array(self._encode_segment(segment), "<u4").tobytes()
                    if len(segment) <= 64:
                        if len(young) >= self.memory:
                            self.old = old = young
                            self.young = young = {}
                        young[segment] = code
                out.append(code)
        out.append(self.eos.to_bytes(4, "little"))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    # -- decoding -----------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        """Pieces back to text: space marks become spaces but for the one that
        encoding put in front, byte pieces join into UTF-8, and each byte that
        is not part of valid UTF-8 becomes U+FFFD."""
        surface = self.surface
        first = next((i for i in ids if not self.invisible[i]), None)
        raw = b"".join([surface[i] for i in ids])
        if first is not None and self.starts_with_space[first]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_lossy(ids)

    def _decode_lossy(self, ids: list[int]) -> str:
        out, run = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(run):
                width = next((w for w in (1, 2, 3, 4) if _valid(run[i: i + w], w)), 0)
                out.append(run[i: i + width].decode() if width else "�")
                i += width or 1
            run.clear()

        seen = False
        for i in ids:
            if self.invisible[i]:
                flush()
                continue
            if self.is_byte[i]:
                run.extend(self.surface[i])
                seen = True
                continue
            flush()
            s = self.surface[i].decode()
            out.append(s[1:] if not seen and self.starts_with_space[i] else s)
            seen = True
        flush()
        return "".join(out)


def _valid(b: bytes | bytearray, width: int) -> bool:
    if len(b) != width:
        return False
    try:
        return len(bytes(b).decode()) == 1
    except UnicodeDecodeError:
        return False


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec per worker process; the vocabulary file is installed on every node."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec.from_file(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, model_path: str, with_ids: bool = True) -> DataFrame:
    """Per document row: doc_id, n_tokens (begin and end included), ids_sha256
    (of little-endian unsigned 32-bit ids), decoded_sha256 and, unless
    ``with_ids`` is off, ids as an array.

    Null texts count as empty and give begin and end only.  Rows are
    independent: repeats, ties and null ids pass through; an empty table gives
    an empty result.  Every distinct segment is encoded by backtracking; the
    memory of segments is bounded and changes no result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in batches:
            n, sha, decoded, ids_out = [], [], [], []
            for text in batch.column("text").to_pylist():
                raw = c.encode_bytes(text or "")
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                sha.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(c.decode(ids.tolist()).encode()).hexdigest())
                ids_out.append(ids.astype(np.int32))
            cols = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                    pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols.append(pa.array(ids_out, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))
