"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text is normalised as the model says (spaces become the space symbol, with one in
front) and cut where no piece of the vocabulary can reach across, as its pieces show:
before a run of space symbols, around line ends, and between a letter or digit and the
mark that follows it. Every part is encoded by a
score-ordered agenda of adjacent symbol pairs: the best-scored pair (leftmost of equals)
merges, its new neighbours join the agenda, stale entries are skipped. Characters that
no piece covers fall back to their UTF-8 bytes. Parts recur, so each task keeps a bounded
table of those it has encoded; every part that enters the table is checked against the
sentencepiece library, one call per Arrow batch, and a difference raises.

Decoding goes from ids to pieces to text: byte pieces are joined to characters, space
symbols become spaces, the one in front goes.

Defined results: a null or empty text has no ids and decodes to the empty text; a text of
any length is encoded whole (one agenda per part, no recursion); rows are independent, so
repeated rows and null ids need no care.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPACE = "▁"
#: Parts that one Python worker remembers at least: as many again that were used before them.
REMEMBERED = 400_000
#: Texts that are encoded between two library checks.
ROWS_PER_STEP = 256


class _Table(dict):
    """Recently used entries; beyond the bound, those not used for longest go."""

    def __init__(self):
        super().__init__()
        self.older: dict = {}

    def __missing__(self, key):
        self[key] = value = self.older[key]
        return value

    def lacks(self, keys) -> list:
        return [k for k in keys if k not in self and k not in self.older]

    def trim(self, bound: int) -> None:
        if len(self) > bound:
            self.older = dict(self)
            self.clear()


def _marks(pieces) -> set[str]:
    """Characters that no piece holds right after a letter."""
    after_letter = {b for piece in pieces for a, b in zip(piece, piece[1:]) if a.isalpha()}
    return {c for piece in pieces for c in piece if not c.isalpha() and c != SPACE} - after_letter


class PieceModel:
    """The vocabulary of one model file and the parts encoded so far."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.surface = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        self.known: dict[str, tuple[float, int]] = {}
        self.silent = set()
        for i, piece in enumerate(self.surface):
            if lib.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
                self.byte_id[self.byte_of[i]] = i
            elif lib.is_control(i):
                self.silent.add(i)
            elif not lib.is_unknown(i):
                self.known[piece] = (lib.get_score(i), i)
        raw = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if i in self.silent
               else p.replace(SPACE, " ").encode() for i, p in enumerate(self.surface)]
        self.piece_size = np.array([len(r) for r in raw], np.int64)
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_spaced = np.array([p[:1] == SPACE for p in self.surface], np.int64)
        if any(SPACE in p.lstrip(SPACE) for p in self.known):
            raise ValueError("a piece holds a space symbol after another character; texts cannot be cut at spaces")
        if len(self.byte_id) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.line_ends = not any("\n" in p for p in self.known)  # no piece reaches across a line end
        self.parts = re.compile(f"{SPACE}+[^{SPACE}\n]*|\n[^{SPACE}\n]*" if self.line_ends else f"{SPACE}+[^{SPACE}]*")
        marks = re.escape("".join(sorted(_marks(self.known))))
        self.stem = re.compile(f"({SPACE}[^\\W\\d_]+)([{marks}].*)", re.S) if marks else re.compile("(?!)")
        self.joined = _Table()

    def merge(self, part: str) -> list[int]:
        """Ids of one part by the agenda."""
        known = self.known
        symbols = list(part)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            hit = known.get(symbols[i] + symbols[i + 1])
            if hit:
                agenda.append((-hit[0], i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = symbols[left], symbols[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            a += b
            symbols[left], symbols[right] = a, ""
            follow = after[left] = after[right]
            if follow < n:
                before[follow] = left
                hit = known.get(a + symbols[follow])
                if hit:
                    heapq.heappush(agenda, (-hit[0], left, follow, size + len(symbols[follow])))
            ahead = before[left]
            if ahead >= 0:
                hit = known.get(symbols[ahead] + a)
                if hit:
                    heapq.heappush(agenda, (-hit[0], ahead, left, size + len(symbols[ahead])))
        ids = []
        for s in symbols:
            if s:
                hit = known.get(s)
                if hit:
                    ids.append(hit[1])
                else:
                    ids.extend(self.byte_id[b] for b in s.encode())
        return ids

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of ids that lie end to end, text k in ids[ends[k]:ends[k + 1]]: the bytes of all
        pieces in a row, without the space that the model puts in front of a text."""
        size = self.piece_size[ids]
        first = ends[:-1][ends[1:] > ends[:-1]]
        skip = np.zeros(len(ids), np.int64)
        skip[first] = self.piece_spaced[ids[first]]
        upto = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size - skip, out=upto[1:])
        begin = self.piece_at[ids] + skip
        spelled = self.piece_bytes[np.repeat(begin - upto[:-1], size - skip) + np.arange(upto[-1])]
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(upto[ends].astype(np.int32)), pa.py_buffer(spelled))

    def cut(self, text: str) -> list[str]:
        """Keys of the parts: a part without the space symbol in front, or one that a line end begins."""
        line = text.replace("\n", " \n") if self.line_ends else text
        if SPACE in line or "  " in line or line[:1] in ("", " ") or line[-1] == " " or line[:2] == " \n":
            whole = self.parts.findall(SPACE + text.replace(" ", SPACE)) if text else []
            return [p[1:] if p[0] == SPACE else p for p in whole]
        return line.split(" ")

    def learn(self, keys) -> None:
        """Encode the parts of keys, check them against the library, remember them."""
        new = self.joined.lacks(keys)
        if not new:
            return
        # the library puts a space symbol in front and gives no ids for nothing
        asked = self.library.encode([k.replace(SPACE, " ") for k in new], num_threads=1)
        alone = f"{self.known[SPACE][1]}"
        for key, theirs in zip(new, asked, strict=True):
            inner = self.line_ends and key[:1] == "\n"
            part = key if inner else SPACE + key
            cut = self.stem.fullmatch(part)
            if cut and cut[1][1:].isalpha():
                stem = cut[1][1:]
                if stem not in self.joined and stem not in self.joined.older:
                    self.joined[stem] = self.spell(cut[1])
                ids = f"{self.joined[stem]},{self.spell(cut[2])}"
            else:
                ids = self.spell(part)
            if ",".join(map(str, theirs)) != (f"{alone},{ids}" if inner else ids) and key:
                raise ValueError(f"encoding of {part!r} differs from the library: {ids} and {theirs}")
            self.joined[key] = ids

    def spell(self, part: str) -> str:
        return ",".join(map(str, self.merge(part)))

    def texts(self, texts: list[str | None]) -> list[str]:
        """Ids of each text, in decimal joined by commas."""
        cuts = [self.cut(t) if t else [] for t in texts]
        self.joined.trim(REMEMBERED)
        self.learn(set().union(*cuts))
        ids = self.joined.__getitem__
        return [",".join(map(ids, keys)) for keys in cuts]


@lru_cache(maxsize=4)
def model(path: str) -> PieceModel:
    """One model per Python worker."""
    return PieceModel(path)


def encoded(docs: DataFrame, model_path: str, *, ids_as: str = "array", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of docs, then n_tokens, ids and decoded of every whole text.

    ``ids_as`` is "array" (array<int>) or "text" (decimal, joined by commas). Columns of
    docs with one of these three names are left out.
    """
    own = {"n_tokens", "ids", "decoded"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in own]
    kind = T.ArrayType(T.IntegerType(), False) if ids_as == "array" else T.StringType()
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", kind), T.StructField("decoded", T.StringType())])
    at = keep.index("text") if "text" in keep else len(keep)
    source = docs.select(*keep, *([] if "text" in keep else ["text"]))
    n_keep = len(keep)

    def step(batches):
        m = model(model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_PER_STEP):
                part = batch.slice(start, ROWS_PER_STEP)
                got = m.texts(part.column(at).to_pylist())
                counts = np.array([ids.count(",") + 1 if ids else 0 for ids in got], np.int64)
                ends = np.concatenate([[0], np.cumsum(counts)])
                flat = np.fromstring(",".join(filter(None, got)), dtype=np.int32, sep=",") if ends[-1] else np.zeros(0, np.int32)
                ids = (pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat)) if ids_as == "array"
                       else pa.array(got, pa.string()))
                columns = [part.column(i) for i in range(n_keep)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts), ids, m.decode(flat, ends)], names=[*keep, "n_tokens", "ids", "decoded"])

    return source.mapInArrow(step, schema)
