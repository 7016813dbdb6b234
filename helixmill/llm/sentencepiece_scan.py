"""SentencePiece BPE encoding as a max-plus scan, and decoding.

A BPE encoding is the one sequence of pieces in which every two neighbours are what BPE
makes of their joined text. So encoding is a path through (piece, place) nodes whose edges
weigh -1 for each id where neighbours agree and minus infinity elsewhere. A giant text is cut
into chunks of fixed length. The state at a cut is the piece that holds the character before
it; a chunk's matrix has the weight of the best path from each state at its left cut to each
at its right one. Matrices combine associatively in the max-plus semiring, within groups of
chunks and then over groups, which fixes the states at all cuts; each chunk then traces its
own path back. No piece holds a space after another character, so between the first and last
such place of a chunk the path doesn't depend on the states: the library encodes that part,
once, when the matrix is made. Other texts are scans of one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, give_back, runs, small_batches, text_slices

CHUNK_CHARS = 16_384
#: Chunks whose matrices one task combines.
GROUP_CHUNKS = 64
#: Texts, and their bytes unless one alone has more, whose ids are Python numbers at a time.
SLICE, SLICE_BYTES = 256, 1 << 20
SPACE = "▁"
NEVER = -np.inf


def piece_bytes(model: bytes) -> list[bytes]:
    """What each id stands for: a piece's text with spaces, or one byte; nothing for control ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else piece.replace(SPACE, " ").encode())
    return out


class PieceModel:
    """A BPE model with byte fallback, an added leading space and no other normalisation."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.agree = lru_cache(1 << 15)(self._agree)
        self.sound = lru_cache(1 << 15)(self._sound)

    @cached_property
    def ids(self) -> dict[str, int]:
        sp = self.sp
        out = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(SPACE in p.lstrip(SPACE) for p in out):
            raise ValueError("a piece holds a space after another character")
        return out

    @cached_property
    def rank(self) -> dict[str, float]:
        return {p: -self.sp.get_score(i) for p, i in self.ids.items()}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.ids))

    @cached_property
    def byte(self) -> dict[int, int]:
        return {int(self.sp.id_to_piece(i)[3:5], 16): i for i in range(self.sp.get_piece_size()) if self.sp.is_byte(i)}

    def _bpe(self, text: str) -> list[str]:
        """Of all neighbours whose joined text is a piece, the best-ranked, then leftmost, join first."""
        parts = list(text)
        while True:
            best = min(((self.rank[j], i) for i in range(len(parts) - 1) if (j := parts[i] + parts[i + 1]) in self.rank), default=None)
            if best is None:
                return parts
            parts[best[1] : best[1] + 2] = ["".join(parts[best[1] : best[1] + 2])]

    def _agree(self, left: str, right: str) -> bool:
        return self._bpe(left + right) == [left, right]

    def _sound(self, piece: str) -> bool:
        return len(piece) == 1 or (piece in self.ids and self._bpe(piece) == [piece])

    def ids_of(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else [self.byte[b] for b in piece.encode("utf-8", "surrogatepass")]

    # States and paths. All places count from the start of the normalised text; s holds it from base on.

    def states(self, s: str, base: int, cut: int) -> list[tuple[int, int]]:
        """(start, end) of every sound piece that holds the character before the cut."""
        out = []
        for i in range(max(base, cut - self.longest), cut):
            for j in range(cut, min(base + len(s), i + self.longest) + 1):
                if self.sound(s[i - base : j - base]):
                    out.append((i, j))
        return out

    def paths(self, s: str, base: int, entry: tuple[int, int], stop: int) -> dict[tuple[int, int], tuple[float, tuple[int, int] | None]]:
        """Best weight and predecessor of every piece that can follow the entry, up to those that hold stop - 1."""
        seen: dict[tuple[int, int], tuple[float, tuple[int, int] | None]] = {entry: (0.0, None)}
        ends: dict[int, list[tuple[int, int]]] = {entry[1]: [entry]}
        for at in range(entry[1], stop):
            for left in ends.pop(at, ()):
                for k in range(at + 1, min(base + len(s), at + self.longest) + 1):
                    piece = s[at - base : k - base]
                    if self.sound(piece) and (left[1] == left[0] or self.agree(s[left[0] - base : left[1] - base], piece)):
                        weight = seen[left][0] - (1 if piece in self.ids else len(piece.encode("utf-8", "surrogatepass")))
                        node = (at, k)
                        if node not in seen:
                            ends.setdefault(k, []).append(node)
                        if node not in seen or weight > seen[node][0]:
                            seen[node] = (weight, left)
        return seen

    def trace(self, s: str, base: int, entry: tuple[int, int], exit_: tuple[int, int], stop: int) -> list[int]:
        seen, node, out = self.paths(s, base, entry, stop), exit_, []
        while node != entry:
            out.append(s[node[0] - base : node[1] - base])
            node = seen[node][1]
        return [i for p in reversed(out) for i in self.ids_of(p)]

    @staticmethod
    def anchors(s: str, base: int, lo: int, hi: int) -> tuple[int, int] | None:
        """The first and last place in [lo, hi] where a space follows another character."""
        first, at = None, lo
        while first is None and (at := s.find(SPACE, at - base, hi - base + 1) + base) >= base + 1:
            first, at = (at, at) if s[at - 1 - base] != SPACE else (None, at + 1)
        if first is None or at < base + 1:
            return None
        last = hi
        while (last := s.rfind(SPACE, first - base, last - base + 1) + base) > first and s[last - 1 - base] == SPACE:
            last -= 1
        return first, last

    def middle(self, s: str, base: int, lo: int, hi: int) -> list[int]:
        return self.sp.encode(s[lo - base + 1 : hi - base], num_threads=1) if hi > lo else []

    def entries(self, s: str, base: int, lo: int) -> list[tuple[int, int]]:
        return self.states(s, base, lo) if lo else [(0, 0)]

    def exits(self, s: str, base: int, hi: int, end: int) -> list[tuple[int, int]]:
        return [x for x in self.states(s, base, hi) if hi < end or x[1] == end]

    def scan(self, s: str, base: int, lo: int, hi: int, end: int) -> tuple[np.ndarray, list[int], tuple[int, int] | None]:
        """Matrix, ids of the part between the anchors, and the anchors of the chunk [lo, hi) of a text that ends at end.

        s reaches longest characters beyond both cuts.
        """
        rows, cols = self.entries(s, base, lo), self.exits(s, base, hi, end)
        out = np.full((len(rows), len(cols)), NEVER)
        cut = self.anchors(s, base, lo + 1, hi - 1)
        tail = self.paths(s, base, (cut[1], cut[1]), hi) if cut else None
        inner = self.middle(s, base, *cut) if cut else []
        for r, entry in enumerate(rows):
            if entry[1] >= hi and not cut:  # the entry's piece holds the whole chunk
                for c, x in enumerate(cols):
                    out[r, c] = 0.0 if x == entry else NEVER
                continue
            seen = self.paths(s, base, entry, cut[0] if cut else hi)
            if cut:
                head = max((w for (_, k), (w, _) in seen.items() if k == cut[0]), default=NEVER)
                for c, x in enumerate(cols):
                    out[r, c] = head - len(inner) + tail[x][0] if x in tail and x != (cut[1], cut[1]) else NEVER
            else:
                for c, x in enumerate(cols):
                    out[r, c] = seen[x][0] if x in seen else NEVER
        return out, inner, cut

    def edges(self, s: str, base: int, hi: int, cut: tuple[int, int] | None) -> tuple[str, str, int]:
        """What a backtrace needs of s: up to the first anchor, from the last one on, and the latter's start."""
        if not cut:
            return s, "", base
        at = max(base, min(cut[1], hi - self.longest))
        return s[: cut[0] - base + self.longest], s[at - base :], at

    def backtrace(self, chunk: dict, entry: int, exit_: int) -> tuple[list[int], list[int]]:
        """Ids before and after those between the anchors: of the pieces after the entry's, up to the exit's with it."""
        base, lo, hi, end, s = (chunk[c] for c in ("base", "lo", "hi", "end", "s"))
        a = self.entries(s, base, lo)[entry]
        if chunk["cut0"] is None:
            b = self.exits(s, base, hi, end)[exit_]
            return (self.trace(s, base, a, b, hi) if a != b else []), []
        first, last, s2, base2 = (chunk[c] for c in ("cut0", "cut1", "s2", "base2"))
        b = self.exits(s2, base2, hi, end)[exit_]
        head = []
        if a[1] != first:
            seen = self.paths(s, base, a, first)
            head = self.trace(s, base, a, max((n for n in seen if n[1] == first), key=lambda n: seen[n][0]), first)
        return head, self.trace(s2, base2, (last, last), b, hi)

    def encode(self, text: str) -> list[int]:
        """A scan of one chunk: no cut, so all of it is the part without states."""
        return self.sp.encode(text, num_threads=1)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product in the max-plus semiring; associative."""
    return (a[:, :, None] + b[None, :, :]).max(1) if a.size and b.size else np.full((a.shape[0], b.shape[1]), NEVER)


def states_between(ms: list[np.ndarray], entry: int, exit_: int | None) -> list[int]:
    """The state before each matrix and after the last, on the best way from entry to exit."""
    best = [np.where(np.arange(ms[0].shape[0]) == entry, 0.0, NEVER)]
    for m in ms:
        best.append((best[-1][:, None] + m).max(0))
    at = [int(best[-1].argmax()) if exit_ is None else exit_]
    for v, m in zip(reversed(best[:-1]), reversed(ms), strict=True):
        at.append(int((v + m[:, at[-1]]).argmax()))
    return at[::-1]


@lru_cache(1)
def piece_model(model: bytes) -> PieceModel:
    """One for each Python worker, whatever the number of its tasks."""
    return PieceModel(model)


def _load(model):
    return lambda: piece_model(model.value)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one: of a batch of long texts only one is a Python object at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["cells"]).reshape(row["rows"], row["cols"])


def normalise(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


PACKED = "rows int, cols int, cells binary"
EDGES = "s string, s2 string, base long, base2 long, lo long, hi long, end long, cut0 long, cut1 long, middle array<int>"


def _batch(kind: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, kind)


def _kind(ddl: str) -> pa.Schema:
    known = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(c.split()[0], known[c.split()[1]]) for c in ddl.split(", ")])


def decoded(ids: pa.ListArray, pieces: pa.Array) -> pa.StringArray:
    """The text of each list of ids, without the added leading space; few lists are Python objects at a time."""
    out = []
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for lo, n in runs(lengths, SLICE, SLICE_BYTES):
        part, sizes = ids.slice(lo, n), lengths[lo : lo + n]
        taken = pieces.take(part.flatten())
        ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4)[np.concatenate([[0], np.cumsum(sizes)])]
        whole = taken.buffers()[2]
        whole = whole.to_pybytes() if whole else b""
        out.append(pa.array([whole[a:b].decode("utf-8", "replace").removeprefix(" ") for a, b in zip(ends, ends[1:], strict=False)], pa.string()))
    return pa.concat_arrays(out) if out else pa.array([], pa.string())


def sp_encode(
    docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, with_decoded: bool = False,
) -> DataFrame:
    """One row per row of docs: id, text_sha256 (of the whole text), ids; with_decoded: and what sp_decode adds.

    The ids are the library's for the whole text, without begin or end. Null text counts as
    empty and has no ids. Repeated rows give repeated rows. An empty table gives no rows.
    A text's chunks are spread over all tasks; its ids, one value of the result, meet in one.
    Decoded here, ids are decoded from themselves in the worker that made them: sp_decode
    behind sp_encode takes a second Python worker a task, and executors keep such workers.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    scratch = Scratch(spark)
    get = _load(spark.sparkContext.broadcast(model))
    shared = spark.sparkContext.broadcast(piece_bytes(model)) if with_decoded else None
    result_names = ["id", "text_sha256", "ids", *["decoded"] * with_decoded]

    def rows_of(pieces: pa.Array | None, ident: pa.Array, sha: pa.Array, ids: pa.ListArray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ident, sha, ids, *([] if pieces is None else [decoded(ids, pieces)])], result_names)

    def get_pieces() -> pa.Array | None:
        return pa.array(shared.value, pa.binary()) if shared else None
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("t"), F.sha2(text.cast("binary"), 256).alias("sha"))
    giant = F.octet_length("t") > chunk_chars  # at least as many as characters: a short one is a scan of one chunk

    result = f"id {kind}, text_sha256 string, ids array<int>" + ", decoded string" * with_decoded

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = get_pieces()
        for batch in batches:
            for lo, n in text_slices(batch.column("t"), SLICE, SLICE_BYTES):
                part = batch.slice(lo, n)
                ids = pa.array([get().encode(t) for t in part.column("t").to_pylist()], pa.list_(pa.int32()))
                yield rows_of(pieces, part.column("id"), part.column("sha"), ids)
            give_back()

    small = base.where(~giant).mapInArrow(whole, result)

    cuts = "row long, chunk long, s string, base long, lo long, hi long, end long"
    named = f"id {kind}, sha string"

    def with_name(ddl: str, batch: pa.RecordBatch) -> pa.Schema:
        return _kind(ddl).append(batch.schema.field("id")).append(batch.schema.field("sha"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row with the text's name, as chunk -1, and one for each chunk."""
        for batch in batches:
            columns, reach = with_name(cuts, batch), get().longest
            for row in _rows([batch]):
                s = normalise(row.pop("t"))
                yield _batch(columns, [row | {"chunk": -1}])
                for c, lo in enumerate(range(0, len(s), chunk_chars)):
                    hi, at = min(len(s), lo + chunk_chars), max(0, lo - reach)
                    yield _batch(columns, [{"row": row["row"], "chunk": c, "s": s[at : hi + reach], "base": at, "lo": lo, "hi": hi, "end": len(s)}])

    # Numbers of rows are of one run only: all that bears them comes from the table of chunks.
    numbered = base.where(giant).withColumn("row", F.monotonically_increasing_id())
    chunks = numbered.mapInArrow(cut, f"{cuts}, {named}").repartition("row", "chunk")
    scanned = f"row long, chunk long, {PACKED}, {EDGES}"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = with_name(scanned, batch)
            for r in _rows([batch]):
                if r["chunk"] >= 0:
                    m, middle, at = get().scan(r["s"], r["base"], r["lo"], r["hi"], r["end"])
                    s, s2, base2 = get().edges(r["s"], r["base"], r["hi"], at)
                    first, last = at or (None, None)
                    r |= {"rows": m.shape[0], "cols": m.shape[1], "cells": m.tobytes(), "s": s, "s2": s2, "base2": base2, "cut0": first, "cut1": last, "middle": middle}
                yield _batch(columns, [r])
            give_back()

    local = scratch.table(chunks.mapInArrow(scan, f"{scanned}, {named}"), "chunks")
    matrices = local.where("chunk >= 0").select("row", F.floor(F.col("chunk") / GROUP_CHUNKS).alias("part"), "chunk", "rows", "cols", "cells")

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (row, part), group in groupby(_rows(batches), lambda r: (r["row"], r["part"])):
            m = None
            for r in group:
                m = _matrix(r) if m is None else times(m, _matrix(r))
            yield _batch(_kind(f"row long, part long, {PACKED}"), [{"row": row, "part": part, "rows": m.shape[0], "cols": m.shape[1], "cells": m.tobytes()}])

    def over_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, group in groupby(_rows(batches), lambda r: r["row"]):
            group = list(group)
            at = states_between([_matrix(r) for r in group], 0, None)
            yield _batch(_kind("row long, part long, a int, b int"), [{"row": row, "part": r["part"], "a": a, "b": b} for r, a, b in zip(group, at, at[1:], strict=False)])

    def over_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (row, _), group in groupby(_rows(batches), lambda r: (r["row"], r["part"])):
            ends, *group = group
            at = states_between([_matrix(r) for r in group], ends["a"], ends["b"])
            yield _batch(_kind("row long, chunk long, entry int, exit int"), [{"row": row, "chunk": r["chunk"], "entry": a, "exit": b} for r, a, b in zip(group, at, at[1:], strict=False)])

    parts = matrices.repartition("row", "part").sortWithinPartitions("row", "part", "chunk").mapInArrow(product, f"row long, part long, {PACKED}")
    ends = parts.repartition("row").sortWithinPartitions("row", "part").mapInArrow(over_parts, "row long, part long, a int, b int")
    # A part's ends stand before its chunks (null comes first). Not by a join: its shuffle would stand for the repartition
    # by the same keys, and where it turns into a broadcast join later, tasks read that shuffle by files and get parts of parts.
    begun = matrices.unionByName(ends, allowMissingColumns=True)
    ways = begun.repartition("row", "part").sortWithinPartitions("row", "part", "chunk").mapInArrow(over_chunks, "row long, chunk long, entry int, exit int")

    # A chunk's way stands before the chunk; each is traced by itself.
    ready = local.drop("rows", "cols", "cells").unionByName(ways, allowMissingColumns=True).repartition("row").sortWithinPartitions("row", "chunk", F.col("entry").isNull())

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, name, way, pieces = [], None, None, get_pieces()

        def flush() -> pa.RecordBatch:
            ids = pa.ListArray.from_arrays(np.array([0, sum(map(len, done))], np.int32), np.concatenate(done) if done else np.zeros(0, np.int32))
            done.clear()
            return rows_of(pieces, *name, ids)

        for batch in batches:
            for k, r in enumerate(_rows([batch.drop_columns(["middle"])])):
                if r["chunk"] < 0:
                    if name is not None:
                        yield flush()
                    name, done = [batch.column(c).slice(k, 1) for c in ("id", "sha")], []
                elif r["entry"] is not None:
                    way = (r["entry"], r["exit"])
                else:
                    head, tail = get().backtrace(r, *way)
                    between = batch.column("middle")[k].values.to_numpy(zero_copy_only=False)
                    done += [np.array(head, np.int32), between.astype(np.int32), np.array(tail, np.int32)]
            give_back()
        if name is not None:
            yield flush()

    large = ready.mapInArrow(trace, result)
    return small.unionByName(large).withColumnRenamed("id", id_col)


def sp_decode(tokens: DataFrame, model: bytes) -> DataFrame:
    """tokens with a column decoded: the text of ids, without the added leading space. Null ids give an empty text."""
    small_batches(tokens.sparkSession)
    shared = tokens.sparkSession.sparkContext.broadcast(piece_bytes(model))

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        pieces = pa.array(shared.value, pa.binary())
        for ids in batches:
            out = decoded(ids, pieces)
            give_back()
            yield out

    return tokens.withColumn("decoded", decode("ids"))


def default_model(path: str | None = None) -> bytes:
    import public_tokenizers

    with open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again.

    The model writes a literal U+2581 as a space, so the round trip is held against the text with that done.
    """
    model = default_model()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.replace(F.coalesce("text", F.lit("")), F.lit(SPACE), F.lit(" ")).alias("text"))
    tokens = sp_decode(sp_encode(docs, model), model)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.length("decoded").cast("long").alias("n_chars"), (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("text_sha256")).alias("round_trip"),
    )
