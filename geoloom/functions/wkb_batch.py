"""Arrow-batch helpers between WKB bytes and the canonical nested geometry.

Both directions work on whole Arrow batches with numpy: no loop over vertices, and over
parts only in the few rows of a batch that have many more of them than the rest. Spark partitions the work; these run inside its tasks.
Measured against the pure-expression form in ``bits``, which is exact too, they
take about a tenth of the time per coordinate.
"""

from __future__ import annotations

import struct
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pyspark.sql import types as T

from geoloom.schema import MEMBERS_TYPE

# Ship these helpers inside the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SRID_FLAG, Z_FLAG, M_FLAG = 0x20000000, 0x80000000, 0x40000000
BLOCK = 1 << 18  # coordinates moved per numpy call, to bound the index arrays
STEPS, FEW = 64, 32  # rows that go on alone: after so many steps, when so few are left

DECODED = T.StructType(
    [
        T.StructField("srid", T.IntegerType()),
        T.StructField("kind", T.IntegerType()),
        T.StructField("members", MEMBERS_TYPE),
        T.StructField("tree", T.ArrayType(T.IntegerType())),
        T.StructField("code", T.StringType()),
    ]
)

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_PARTS = pa.list_(pa.list_(pa.list_(_POINT)))
_MEMBER = pa.struct([("kind", pa.int32()), ("parts", _PARTS)])

_RESULT = pa.struct([("srid", pa.int32()), ("kind", pa.int32()), ("members", pa.list_(_MEMBER)), ("tree", pa.list_(pa.int32())), ("code", pa.string())])

_OK, _PARSE, _NESTED = 0, 1, 2


class _Bytes:
    """Bounds are the caller's duty; reads are gathers over many positions at once."""

    def __init__(self, data: pa.Array):
        offsets = np.frombuffer(data.buffers()[1], np.int32, len(data) + 1, data.offset * 4)
        body = data.buffers()[2]
        self.raw = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        self.start = offsets[:-1].astype(np.int64)
        self.end = offsets[1:].astype(np.int64)

    def word(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        four = self.raw[at[:, None] + np.arange(4)].astype(np.int64)
        four = np.where(little[:, None], four, four[:, ::-1])
        return four @ np.array([1, 1 << 8, 1 << 16, 1 << 24], np.int64)

    def double(self, at: np.ndarray, little: np.ndarray) -> np.ndarray:
        out = np.empty(len(at), np.float64)
        for lo in range(0, len(at), BLOCK):
            part, le = at[lo : lo + BLOCK], little[lo : lo + BLOCK]
            eight = self.raw[part[:, None] + np.arange(8)]
            if not le.all():
                eight = np.where(le[:, None], eight, eight[:, ::-1])
            out[lo : lo + BLOCK] = np.ascontiguousarray(eight).view("<f8")[:, 0]
        return out


class _Walk:
    """Walks the headers of all rows of a batch in lock step.

    Every step reads one header or one ring count in each row still active, and
    logs where members, parts and rings begin; those places put them in order. Counts are
    tested against the bytes that are left before anything is allocated for them. When few
    rows are left after many steps, each goes on alone.
    """

    def __init__(self, data: _Bytes, skip: np.ndarray, prefixed: bool):
        n = len(data.start)
        self.data, self.n = data, n
        self.status = np.zeros(n, np.int8)
        self.kind = np.zeros(n, np.int32)
        self.srid = np.zeros(n, np.int64)
        self.pos = data.start + (4 if prefixed else 0)
        self.little = np.zeros(n, bool)  # big-endian until a byte-order mark says otherwise
        self.dims = np.full(n, 2, np.int64)
        self.base = np.zeros(n, np.int64)
        self.members_left = np.zeros(n, np.int64)
        self.parts_left = np.zeros(n, np.int64)
        self.rings_left = np.zeros(n, np.int64)
        self.head = np.zeros(n, np.int64)  # where the header read last begins
        self.kinds = np.zeros(n, np.int64)
        self.log = {"member": [], "part": [], "ring": []}
        self.trees: dict[int, list[int]] = {}  # of rows with collections in collections
        live = np.flatnonzero(~skip)
        if prefixed:
            live = self._fits(live, 0, from_start=True)
            self.srid[live] = data.word(data.start[live], np.ones(len(live), bool))
        step = 0
        top = True
        while len(live):
            rings = live[self.rings_left[live] > 0]
            heads = live[self.rings_left[live] == 0]
            live = np.union1d(self._rings(rings), self._headers(heads, top, prefixed))
            more = (self.rings_left[live] > 0) | (self.parts_left[live] > 0) | (self.members_left[live] > 0)
            live = live[more]
            top = False
            step += 1
            if step >= STEPS and len(live) <= FEW:
                for row in live.tolist():
                    self._alone(row)
                break
        nested = self.status == _NESTED
        if nested.any():
            # These rows are read anew, each with the children its open collections await.
            for what, entries in self.log.items():
                keep = [~nested[e[0]] for e in entries]
                self.log[what] = [tuple(c[k] for c in e) for e, k in zip(entries, keep)]
            self.status[nested] = _OK
            for row in np.flatnonzero(nested).tolist():
                self.pos[row] = data.start[row] + (4 if prefixed else 0)
                self.members_left[row], self.parts_left[row], self.rings_left[row] = 1, 0, 0
                self.trees[row] = []
                self._alone(row)

    def _fail(self, rows, code=_PARSE):
        self.status[rows] = code

    def _fits(self, rows, need, from_start=False):
        room = self.data.end[rows] - self.pos[rows]
        ok = room >= (np.asarray(need) if not from_start else 0)
        self._fail(rows[~ok])
        return rows[ok]

    def _note(self, what, rows, at, *extra):
        if len(rows):
            self.log[what].append((rows, at, *extra))

    def _count(self, rows, smallest):
        """Read a count; rows whose count cannot fit the bytes left fail."""
        rows = self._fits(rows, 4)
        counts = self.data.word(self.pos[rows], self.little[rows])
        self.pos[rows] += 4
        size = smallest[rows] if isinstance(smallest, np.ndarray) else smallest
        ok = counts * size <= self.data.end[rows] - self.pos[rows]
        self._fail(rows[~ok])
        return rows[ok], counts[ok]

    def _ring(self, rows, counts):
        # The byte before the vertices is after its part's beginning, and before the next part's.
        at = self.pos[rows].copy()
        self._note("ring", rows, at - 1, at, counts, self.dims[rows] * 8, self.little[rows].copy())
        self.pos[rows] += counts * self.dims[rows] * 8

    def _rings(self, rows):
        rows, counts = self._count(rows, self.dims * 8)
        self._ring(rows, counts)
        self.rings_left[rows] -= 1
        return rows

    def _headers(self, rows, top, prefixed):
        rows = self._fits(rows, 5)
        self.head[rows] = self.pos[rows]
        mark = self.data.raw[self.pos[rows]]
        self.little[rows] = np.where(mark == 1, True, np.where(mark == 0, False, self.little[rows]))
        word = self.data.word(self.pos[rows] + 1, self.little[rows])
        self.pos[rows] += 5
        low = word & 0xFFFF
        kind, iso = low % 1000, low // 1000
        self.dims[rows] = (
            2 + (((word & Z_FLAG) != 0) | (iso == 1) | (iso == 3)) + (((word & M_FLAG) != 0) | (iso == 2) | (iso == 3))
        )
        flagged = (word & SRID_FLAG) != 0
        kinds = self.kinds
        kinds[rows] = kind
        held = self._fits(rows[flagged], 4)
        if top and not prefixed:
            self.srid[held] = self.data.word(self.pos[held], self.little[held])
        self.pos[held] += 4
        rows = np.union1d(rows[~flagged], held)

        in_multi = self.parts_left[rows] > 0
        wrong = (in_multi & (kinds[rows] != self.base[rows])) | (kinds[rows] < 1) | (kinds[rows] > 7)
        nested = ~wrong & (kinds[rows] == 7) & (not top)
        self._fail(rows[wrong])
        self._fail(rows[nested], _NESTED)
        in_multi, rows = in_multi[~(wrong | nested)], rows[~(wrong | nested)]
        self.parts_left[rows[in_multi]] -= 1
        outer = rows[~in_multi]
        if top:
            self.kind[outer] = kinds[outer]
        else:
            self.members_left[outer] -= 1

        k = kinds[rows]
        done = []
        bags, counts = self._count(rows[k == 7], 9)
        self.members_left[bags] = counts
        done.append(bags)

        member = outer[kinds[outer] != 7]
        self._note("member", member, self.head[member], kinds[member])
        multi, counts = self._count(rows[(k >= 4) & (k <= 6)], 9)
        self.parts_left[multi] = counts
        self.base[multi] = kinds[multi] - 3
        done.append(multi)

        simple = rows[k <= 3]
        self._note("part", simple, self.head[simple])
        points = rows[k == 1]
        points = self._fits(points, self.dims[points] * 8)
        self._ring(points, np.ones(len(points), np.int64))
        done.append(points)
        lines, counts = self._count(rows[k == 2], self.dims * 8)
        self._ring(lines, counts)
        done.append(lines)
        areas, counts = self._count(rows[k == 3], 4)
        self.rings_left[areas] = counts
        done.append(areas)
        return np.unique(np.concatenate(done))

    def _alone(self, row: int) -> None:
        """Read the rest of one row: header by header, but runs of like points at once."""
        raw, end = self.data.raw, int(self.data.end[row])
        pos, little, dims = int(self.pos[row]), bool(self.little[row]), int(self.dims[row])
        members, parts, rings = (int(a[row]) for a in (self.members_left, self.parts_left, self.rings_left))
        tree, above = self.trees.get(row), []
        base = int(self.base[row])
        words = {True: struct.Struct("<I").unpack_from, False: struct.Struct(">I").unpack_from}
        noted: dict[str, list[tuple]] = {"member": [], "part": [], "ring": []}
        status = _OK

        def count(smallest: int) -> int:
            """A count whose items fit the bytes left, else -1."""
            nonlocal pos
            if end - pos < 4:
                return -1
            n = words[little](raw, pos)[0]
            pos += 4
            return n if n * smallest <= end - pos else -1

        def ring(n: int) -> None:
            nonlocal pos
            noted["ring"].append((pos - 1, pos, n, dims * 8, little))
            pos += n * dims * 8

        while rings or parts or members or above:
            if not (rings or parts or members):
                members = above.pop()
                continue
            if rings:
                n = count(dims * 8)
                if n < 0:
                    status = _PARSE
                    break
                ring(n)
                rings -= 1
                continue
            if parts and base == 1 and (n := self._like_points(row, pos, end, parts, noted)):
                parts -= n
                little, dims = noted["ring"][-1][4], noted["ring"][-1][3] // 8
                pos = noted["ring"][-1][1] + dims * 8
                continue
            if end - pos < 5:
                status = _PARSE
                break
            head = pos
            if raw[pos] <= 1:
                little = bool(raw[pos])
            word = words[little](raw, pos + 1)[0]
            pos += 5
            low = word & 0xFFFF
            kind, iso = low % 1000, low // 1000
            dims = 2 + (bool(word & Z_FLAG) or iso in (1, 3)) + (bool(word & M_FLAG) or iso in (2, 3))
            if word & SRID_FLAG:
                pos += 4
            if pos > end or (parts and kind != base) or not 1 <= kind <= 7:
                status = _PARSE
                break
            if kind == 7:
                n = -1 if tree is None or parts else count(9)
                if n < 0:
                    status = _PARSE if tree is not None else _NESTED
                    break
                tree.append(n)
                if members > 1:
                    above.append(members - 1)
                members = n
                continue
            if parts:
                parts -= 1
            else:
                members -= 1
                noted["member"].append((head, kind))
                if tree is not None:
                    tree.append(-1)
            if kind > 3:
                n = count(9)
                parts, base = max(n, 0), kind - 3
            else:
                noted["part"].append((head,))
                n = 1 if kind == 1 and dims * 8 <= end - pos else -1 if kind == 1 else count(dims * 8 if kind == 2 else 4)
                if n >= 0 and kind <= 2:
                    ring(n)
                elif n >= 0:
                    rings = n
            if n < 0:
                status = _PARSE
                break
        self.status[row] = status
        if status == _OK:
            for what, entries in noted.items():
                if entries:
                    columns = [np.array(c) for c in zip(*entries)]
                    self._note(what, np.full(len(entries), row), *columns)

    def _like_points(self, row: int, pos: int, end: int, n: int, noted: dict[str, list[tuple]]) -> int:
        """Note the points from ``pos`` on whose headers are those of the first; all of them or none.

        Only the last is noted here, for the caller; the rest go to the log as arrays.
        """
        raw = self.data.raw
        if end - pos < 5 or raw[pos] > 1:
            return 0
        little = bool(raw[pos])
        word = int.from_bytes(raw[pos + 1 : pos + 5].tobytes(), "little" if little else "big")
        low = word & 0xFFFF
        kind, iso = low % 1000, low // 1000
        dims = 2 + (bool(word & Z_FLAG) or iso in (1, 3)) + (bool(word & M_FLAG) or iso in (2, 3))
        size = 5 + dims * 8
        if kind != 1 or word & SRID_FLAG or n * size > end - pos:
            return 0
        heads = raw[pos : pos + n * size].reshape(n, size)[:, :5]
        if not (heads == heads[0]).all():
            return 0
        at = pos + size * np.arange(n - 1, dtype=np.int64)
        rows = np.full(n - 1, row)
        self._note("part", rows, at)
        self._note("ring", rows, at + 4, at + 5, np.ones(n - 1, np.int64), np.full(n - 1, dims * 8), np.full(n - 1, little))
        last = pos + size * (n - 1)
        noted["part"].append((last,))
        noted["ring"].append((last + 4, last + 5, 1, dims * 8, little))
        return n

    def events(self, what, width):
        """Log entries of the rows that were read to the end, in the order of their places."""
        if not self.log[what]:
            return [np.zeros(0, np.int64) for _ in range(width)], np.zeros(0, np.int64)
        cols = [np.concatenate(c) for c in zip(*self.log[what])]
        keep = self.status[cols[0]] == _OK
        cols = [c[keep] for c in cols]
        key = cols[1]
        order = np.argsort(key, kind="stable")
        return [c[order] for c in cols], key[order]


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _offsets(starts: np.ndarray) -> np.ndarray:
    if starts[-1] >= 1 << 31:
        raise OverflowError("a batch holds more than its offsets can count; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    return starts.astype(np.int32)


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_offsets(_starts(counts))), values)


def _owner(keys: np.ndarray, parent_keys: np.ndarray) -> np.ndarray:
    return np.searchsorted(parent_keys, keys, side="right") - 1


def _closed_ends(data, first, last, stride, little):
    """First and last vertex of rings, to see whether they meet."""
    fx, fy = data.double(first, little), data.double(first + 8, little)
    lx, ly = data.double(last, little), data.double(last + 8, little)
    return (fx == lx) & (fy == ly), np.isnan(fx) | np.isnan(fy)


def _decode(data: pa.Array, prefixed: bool) -> pa.Array:
    n = len(data)
    if n == 0:
        return pa.nulls(0, _RESULT)
    src = _Bytes(data)
    skip = np.asarray(data.is_null()).astype(bool)
    walk = _Walk(src, skip, prefixed)

    # Readers of this format mend short lines and open rings; rings that cannot
    # be closed, and holes without a shell, make the row unreadable.
    (m_row, _, m_kind), m_key = walk.events("member", 3)
    (p_row, _), p_key = walk.events("part", 2)
    (r_row, _, r_at, r_n, r_step, r_le), r_key = walk.events("ring", 6)
    p_member = _owner(p_key, m_key)
    r_part = _owner(r_key, p_key)
    base = (m_kind - 1) % 3 + 1
    r_base = base[p_member][r_part] if len(r_part) else np.zeros(0, np.int64)
    size = r_n.copy()
    size[(r_base == 2) & (r_n == 1)] = 2
    area = np.flatnonzero((r_base == 3) & (r_n > 0))
    if len(area):
        last = r_at[area] + (r_n[area] - 1) * r_step[area]
        closed, nan = _closed_ends(src, r_at[area], last, r_step[area], r_le[area])
        open_ = ~(closed & (r_n[area] > 3))
        size[area[open_]] = np.maximum(r_n[area[open_]] + 1, 4)
        walk.status[r_row[area[nan]]] = _PARSE
    if len(r_part):
        first_of_part = np.concatenate([[True], r_part[1:] != r_part[:-1]])
        shell_empty = np.zeros(len(p_row), bool)
        shell_empty[r_part[first_of_part & (r_n == 0) & (r_base == 3)]] = True
        walk.status[r_row[shell_empty[r_part] & (r_n > 0)]] = _PARSE

    live = walk.status == _OK
    keep_m, keep_p, keep_r = live[m_row], live[p_row], live[r_row]
    rings_in_part = np.bincount(r_part[keep_r], minlength=len(p_row))[keep_p]
    parts_in_member = np.bincount(p_member[keep_p], minlength=len(m_row))[keep_m]
    members_in_row = np.bincount(m_row[keep_m], minlength=n)

    size, r_n, r_at, r_step, r_le, r_base = (a[keep_r] for a in (size, r_n, r_at, r_step, r_le, r_base))
    total = int(size.sum())
    ring_of = np.repeat(np.arange(len(size)), size)
    local = np.arange(total) - _starts(size)[:-1][ring_of]
    beyond = local >= r_n[ring_of]
    local = np.where(beyond, np.where(r_base[ring_of] == 2, r_n[ring_of] - 1, 0), local)
    at = r_at[ring_of] + local * r_step[ring_of]
    le = r_le[ring_of].astype(bool)
    vertices = pa.StructArray.from_arrays(
        [pa.array(src.double(at, le)), pa.array(src.double(at + 8, le))], fields=list(_POINT)
    )
    parts = _lists(parts_in_member, _lists(rings_in_part, _lists(size, vertices)))
    members = pa.StructArray.from_arrays([pa.array(m_kind[keep_m].astype(np.int32)), parts], fields=list(_MEMBER))
    good = live & ~skip
    names = np.array([None, "WKB_PARSE"], object)
    trees = pa.array([walk.trees.get(i) if good_row else None for i, good_row in enumerate(good.tolist())] if walk.trees else [None] * n, pa.list_(pa.int32()))
    srid = np.where(walk.srid >= 2**31, walk.srid - 2**32, walk.srid).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(srid, mask=~good),
            pa.array(walk.kind, mask=~good),
            _lists(members_in_row, members),
            trees,
            pa.array(names[walk.status], pa.string()),
        ],
        fields=list(_RESULT),
    )


def _children(column: pa.ListArray):
    """Offsets and values of a list column, as they lie in this batch."""
    return np.asarray(column.offsets).astype(np.int64), column.values


def _place(parent_start, header, size, offsets):
    """Start of each child laid out in order behind its parent's header."""
    before = _starts(size)
    count = np.diff(offsets)
    first = before[offsets[:-1]]
    return np.repeat(parent_start + header - first, count) + before[offsets[0] : offsets[-1]]


def _total(size, offsets):
    before = _starts(size)
    return before[offsets[1:]] - before[offsets[:-1]]


def _encode(geom: pa.StructArray, extended: bool) -> pa.Array:
    n = len(geom)
    if n == 0:
        return pa.nulls(0, pa.binary())
    null = np.asarray(geom.is_null()).astype(bool)
    kind = np.asarray(geom.field("kind").fill_null(0)).astype(np.int64)
    srid = np.asarray(geom.field("srid").fill_null(0)).astype(np.int64)
    m_off, members = _children(geom.field("members"))
    if null.any():  # a null row must own no members
        alive = np.diff(m_off) * ~null
        if alive.sum() != m_off[-1] - m_off[0]:
            members = members.take(pa.array(np.flatnonzero(np.repeat(~null, np.diff(m_off))) + m_off[0]))
            m_off = _starts(alive)
    trees = geom.field("tree") if geom.type.get_field_index("tree") >= 0 else pa.nulls(n)
    nested = np.flatnonzero(np.asarray(pc.and_(trees.is_valid(), pa.array(~null))).astype(bool))
    m_kind = np.asarray(members.field("kind")).astype(np.int64)
    p_off, parts = _children(members.field("parts"))
    r_off, rings = _children(parts)
    v_off, vertices = _children(rings)
    multi = m_kind > 3
    base = (m_kind - 1) % 3 + 1
    p_base = np.repeat(base, np.diff(p_off))
    p_multi = np.repeat(multi, np.diff(p_off))
    r_base = np.repeat(p_base, np.diff(r_off))

    r_head = np.where(r_base >= 2, 4, 0)
    r_size = r_head + np.diff(v_off) * 16
    p_head = np.where(p_multi, 5, 0) + np.where(p_base == 3, 4, 0)
    p_size = p_head + _total(r_size, r_off)
    m_head = 5 + np.where(multi, 4, 0)
    m_size = m_head + _total(p_size, p_off)

    # A collection has its own header; any other kind is its only member's body.
    flag = 4 if extended else 0
    prefix = 0 if extended else 4
    bag = kind == 7
    row_head = np.where(bag, 9 + flag, flag) + prefix
    row_size = np.where(null, 0, row_head + _total(m_size, m_off))
    starts = _starts(row_size)
    out = np.zeros(int(starts[-1]), np.uint8)

    def put_word(at, values):
        out[at[:, None] + np.arange(4)] = (values & 0xFFFFFFFF).astype("<u4").view(np.uint8).reshape(-1, 4)

    def put_header(at, kinds):
        out[at] = 1
        put_word(at + 1, kinds)

    row_at = starts[:-1]
    m_at = _place(row_at, row_head, m_size, m_off)
    p_at = _place(m_at, m_head, p_size, p_off)
    r_at = _place(p_at, p_head, r_size, r_off)

    put_header(m_at, m_kind)
    put_word(m_at[multi] + 5, np.diff(p_off)[multi])
    put_header(p_at[p_multi], p_base[p_multi])
    area = p_base == 3
    put_word(p_at[area] + np.where(p_multi[area], 5, 0), np.diff(r_off)[area])
    counted = r_base >= 2
    put_word(r_at[counted], np.diff(v_off)[counted])
    bags = np.flatnonzero(bag & ~null)
    live = np.flatnonzero(~null)
    if extended:
        # The flagged header takes the place of the only member's plain header.
        put_header(row_at[live], kind[live] | SRID_FLAG)
        put_word(row_at[live] + 5, srid[live])
        put_word(row_at[bags] + 9, np.diff(m_off)[bags])
    else:
        put_word(row_at[live], srid[live])
        put_header(row_at[bags] + 4, kind[bags])
        put_word(row_at[bags] + 9, np.diff(m_off)[bags])

    count = np.diff(v_off)
    v_at = np.repeat(r_at + np.where(counted, 4, 0) - (v_off[:-1] - v_off[0]) * 16, count)
    v_at += np.arange(len(v_at)) * 16
    x = np.asarray(vertices.field("x"))[v_off[0] : v_off[-1]]
    y = np.asarray(vertices.field("y"))[v_off[0] : v_off[-1]]
    for lo in range(0, len(v_at), BLOCK):
        part = slice(lo, lo + BLOCK)
        pair = np.stack([x[part], y[part]], axis=1).astype("<f8")
        out[v_at[part][:, None] + np.arange(16)] = pair.view(np.uint8).reshape(-1, 16)
    body = pa.Array.from_buffers(
        pa.binary(), n, [None, pa.py_buffer(_offsets(starts).tobytes()), pa.py_buffer(out.tobytes())]
    )
    if null.any():
        body = pa.Array.from_buffers(pa.binary(), n, [pa.array(~null).buffers()[1], *body.buffers()[1:]])
    if len(nested):
        texts = []
        leaf_at = m_off - m_off[0]
        for row in nested.tolist():
            leaves = iter(range(leaf_at[row], leaf_at[row + 1]))
            head = out[row_at[row] : row_at[row] + row_head[row] - 4].tobytes()
            texts.append(_with_tree(head, trees[row].as_py(), (out[m_at[i] : m_at[i] + m_size[i]].tobytes() for i in leaves)))
        body = pc.replace_with_mask(body, pa.array(np.isin(np.arange(n), nested)), pa.array(texts, pa.binary()))
    return body


def _with_tree(head: bytes, tree: list[int], leaves) -> bytes:
    """A collection's bytes up to its count, its nodes in preorder and the bytes of its leaves -> all its bytes."""
    parts = [head, struct.pack("<I", tree[0])]
    parts += [next(leaves) if size < 0 else struct.pack("<BII", 1, 7, size) for size in tree[1:]]
    return b"".join(parts)


@F.arrow_udf(DECODED)
def decode_prefixed(data: pa.Array) -> pa.Array:
    return _decode(data, prefixed=True)


@F.arrow_udf(DECODED)
def decode_extended(data: pa.Array) -> pa.Array:
    return _decode(data, prefixed=False)


@F.arrow_udf(T.BinaryType())
def encode_prefixed(geom: pa.Array) -> pa.Array:
    return _encode(geom, extended=False)


@F.arrow_udf(T.BinaryType())
def encode_extended(geom: pa.Array) -> pa.Array:
    return _encode(geom, extended=True)
