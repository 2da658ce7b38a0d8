"""N-gram Jaccard join by parity sketches, and the groups of documents that its links make.

A document's set are the distinct ``WORDS``-word shingles of its lower-cased (A-Z) words. Two documents link when
100 x intersection >= ``PERCENT`` x union. All of this is exact; nothing is sampled or capped.

*Sketch.* Every shingle's hash flips one bit of a very wide bit sketch. The sketch of A differs from that
of B in at most |A xor B| bits. For a link with sizes a <= b, |A xor B| <= (a + b) / 9 (at 80 %).

*Pigeonhole join per size band.* Sizes are cut into bands. The band of the smaller document fixes a layout: d bits may
differ, and the sketch is cut into d + 1 + slack blocks, so at least 1 + slack of them are identical in a
linked pair. A document takes part in the layouts of all bands that a smaller partner may have. It sends a
64-bit code of each block that has set bits (48 bits of it travel; a clash only adds a candidate). Since the
slack exceeds the number of empty blocks, linked documents share ``need`` = filled blocks - d codes at
least. The rare document with too few filled blocks sends its shingles as codes too.

*Grouping.* Map tasks write the codes as arrays, one for each part of the code space, so Spark shuffles few
large rows and no row per code. Each layout has a part for every ``PART_BYTES`` of text (counted first), so a part's size does not
grow with the corpus. Each part finds the codes that several different sets share. Equal
sets count once: they are one node, whatever the number of copies.

*Candidates.* Nodes that share fewer than ``need`` codes in every layout drop out (passages and boilerplate
that many documents share end here). What is left are groups of nodes by code. No group is expanded into pairs:
each node is verified against the most central node of its groups (``STARS`` rounds); verified links make
components. In a group whose nodes are still in different components, those outside its largest one are compared with
all others by their bit sketches, in blocks: only pairs whose Hamming distance lets them link leave the task. Of a
node's groups only the rarest have to be looked at for that (``_rarest``).

*Verification* compares the shingle sets themselves.

Defined results: null or wordless text has no shingles, is linked with nothing and is its own component;
fewer than ``WORDS`` words make one shingle; rows without doc_id take no part and have a null component;
repeated rows are copies; an empty table gives an empty result; other columns are ignored. Sets are
compared by 64-bit shingle hashes, equal sets by 64-bit sums that a second sum must confirm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskmetrics.llm.common import byte_slices, hold, ragged, text_parts, written

WORDS = 5
PERCENT = 80
#: Share of extra blocks, and the least number of them.
SLACK, LEAST_SLACK = 0.4, 4
STARS = 3
#: Bits of a node's sketch for each bit that may differ.
SKETCH_BITS = 6
#: Nodes of a group that a task compares with as many others.
COMPARED = 1024
#: Text bytes for each part of a layout's code space; the codes of a layout are about as many bytes as the texts.
PART_BYTES = 32 << 20
#: Text bytes that a task sketches at once; its arrays take some 40 times as much.
SKETCH_BYTES = 3 << 19
#: Ids of up to so many candidates are broadcast to pick their texts; beyond, the join is shuffled.
BROADCAST_IDS = 2_000_000

_U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE, _INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    hold("jaccard", _POWERS.clear)
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        ones = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        _POWERS[:] = [np.cumprod(np.append(_U(1), x[:-1]), dtype=np.uint64) for x in ones]
    return _POWERS[0], _POWERS[1]


def shingles(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending within each, and n + 1 offsets."""
    n = len(off) - 1
    low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
    word = ~_BLANK[low]
    starts = np.zeros(len(raw) + 1, bool)
    starts[off] = True
    first = np.flatnonzero(word & (np.append(True, ~word[:-1]) | starts[:-1])) if len(raw) else np.zeros(0, np.int64)
    last = np.flatnonzero(word & (np.append(~word[1:], True) | starts[1:])) + 1 if len(raw) else np.zeros(0, np.int64)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    # The hash of a word: a polynomial in its bytes, from differences of running sums.
    up, down = _powers(len(raw))
    upto = np.append(_U(0), np.cumsum(_BYTE[low] * up[: len(raw)], dtype=np.uint64))
    code = _mix((upto[last] - upto[first]) * down[first] + (last - first).astype(np.uint64))
    doc = np.searchsorted(off, first, side="right") - 1
    words = np.bincount(doc, minlength=n)
    ends = np.cumsum(words)
    # Shingle at every word that has enough words of its text behind it, or at the first of a short text.
    at = np.arange(len(code))
    left = ends[doc] - at
    opens = np.flatnonzero((left >= WORDS) | ((words[doc] < WORDS) & (at == ends[doc] - words[doc])))
    h = np.zeros(len(opens), np.uint64)
    length = np.minimum(left[opens], WORDS)
    for k in range(WORDS):
        some = length > k
        h[some] = _mix(h[some] * _U(0x9E3779B97F4A7C15) + code[opens[some] + k] + _U(k + 1))
    owner = doc[opens]
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))
    h, owner = h[fresh], owner[fresh]
    return h, np.append(0, np.cumsum(np.bincount(owner, minlength=n)))


def fingerprints(h: np.ndarray, upto: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit sums of each set."""
    out = []
    for salt in (0x1B873593CC9E2D51, 0x2545F4914F6CDD1D):
        total = np.append(_U(0), np.cumsum(_mix(h ^ _U(salt)), dtype=np.uint64))
        out.append(_mix(total[upto[1:]] - total[upto[:-1]] + np.diff(upto).astype(np.uint64)))
    return out[0], out[1]


class Layouts:
    """Size bands and their block layouts, up to any size."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.high = [1]

    def _grow(self, size: int) -> None:
        while self.high[-1] < size:
            self.high.append(max(self.high[-1] + 1, self.high[-1] * 100 // self.percent))

    def smaller(self, size: np.ndarray) -> np.ndarray:
        """Least size that may link with ``size``."""
        return -(-size * self.percent // 100)

    def band(self, size: np.ndarray) -> np.ndarray:
        self._grow(int(size.max(initial=1)))
        return np.searchsorted(self.high, size)

    def differ(self) -> np.ndarray:
        """Bits that may differ, by band."""
        a = np.array(self.high)
        return (a + a * 100 // self.percent) * (100 - self.percent) // (100 + self.percent)

    def blocks(self) -> np.ndarray:
        d = self.differ()
        return d + 1 + np.maximum((d * SLACK).astype(int), LEAST_SLACK)


def block_codes(h: np.ndarray, upto: np.ndarray, layouts: Layouts) -> tuple[np.ndarray, ...]:
    """Rows (set, layout), their ``need``, and the codes: row, block, 64-bit code."""
    size = np.diff(upto)
    high_band, low_band = layouts.band(size), layouts.band(layouts.smaller(size))
    differ, blocks = layouts.differ(), layouts.blocks()
    many = np.where(size > 0, high_band - low_band + 1, 0)
    owner = np.repeat(np.arange(len(size)), many)
    layout = ragged(low_band, many)
    useful = differ[layout] > 0  # else only equal sets link
    owner, layout = owner[useful], layout[useful]
    n = size[owner]
    x = h[ragged(upto[owner], n)]
    row = np.repeat(np.arange(len(owner)), n)
    wide = blocks[layout]
    base = np.cumsum(wide) - wide
    slot = base[row] + (x % wide[row].astype(np.uint64)).astype(np.int64)
    code = np.zeros(int(wide.sum()), np.uint64)
    np.bitwise_xor.at(code, slot, _mix(x // wide[row].astype(np.uint64) + _U(1)))
    filled = np.flatnonzero(code)
    of = np.repeat(np.arange(len(owner)), wide)[filled]
    block = filled - base[of]
    need = np.bincount(of, minlength=len(owner)) - differ[layout]
    key = _mix(code[filled] ^ _mix((layout[of].astype(np.uint64) << _U(32)) + block.astype(np.uint64)))
    few = need < 1
    if few.any():
        own = few[row]
        of = np.append(of, row[own])
        block = np.append(block, slot[own] - base[row[own]])
        key = np.append(key, _mix(x[own] ^ _U(0xA5A5A5A5A5A5A5A5) ^ _mix(layout[row[own]].astype(np.uint64))))
        need = np.where(few, 1, need)
    return owner, layout, need, of, block, key


ROWS = "kind tinyint, gid bigint, node bigint, layout smallint, need int, n int, times bigint, doc_id bigint"
_NAMES = ["kind", "gid", "node", "layout", "need", "n", "times", "doc_id"]


def _sketch_rows(parts: int):
    """Arrow function: per slice and part of the code space one row with arrays of codes; plus one row of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts()
        spread = 0
        for batch in byte_slices(batches, "text", SKETCH_BYTES):
            h, upto = shingles(*text_parts(batch.column("text")))
            fp, second = fingerprints(h, upto)
            ids = batch.column("doc_id")
            valid = ids.is_valid().to_numpy(zero_copy_only=False)
            doc = np.array(ids.fill_null(0).to_numpy(), np.int64)
            rows = np.rec.fromarrays(
                [fp, second, doc, np.diff(upto).astype(np.int32), valid.astype(np.int8)], names="fp,second,doc,n,valid"
            )
            spread += 1
            out = [(-1 - (spread * 7919 + int(doc[0])) % parts, rows.tobytes())]
            use = np.flatnonzero(valid & (np.diff(upto) > 0))  # before the copies go: one without id must not stand for the others
            once = use[np.unique(fp[use], return_index=True)[1]]
            many = np.diff(upto)[once]
            h, fp = h[ragged(upto[once], many)], fp[once]
            owner, layout, need, of, block, key = block_codes(h, np.append(0, np.cumsum(many)), layouts)
            wide = np.minimum(parts, layouts.blocks())[layout[of]]
            deep = -(-parts // layouts.blocks())[layout[of]]
            part = (layout[of] * parts + block % wide) * 4096 + (key >> _U(48)).astype(np.int64) % np.minimum(deep, 4096)
            order = np.lexsort((of, part))
            part, of, key = part[order], of[order], key[order]
            ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)) if len(part) else []
            start = 0
            for end in ends:
                own, times = np.unique(of[start:end], return_counts=True)
                head = np.rec.fromarrays(
                    [fp[owner[own]], many[owner[own]].astype(np.int32), need[own].astype(np.int32), times.astype(np.int32)], names="fp,n,need,times"
                )
                codes = np.ascontiguousarray(key[start:end]).view(np.uint8).reshape(-1, 8)[:, :6]
                out.append((int(part[start]), np.int64(len(own)).tobytes() + head.tobytes() + codes.tobytes()))
                start = end
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in out], pa.int64()), pa.array([b for _, b in out], pa.binary())], ["part", "payload"]
            )

    return run


_DOC = np.dtype([("fp", "<u8"), ("second", "<u8"), ("doc", "<i8"), ("n", "<i4"), ("valid", "i1")])
_HEAD = np.dtype([("fp", "<u8"), ("n", "<i4"), ("need", "<i4"), ("times", "<i4")])


def _shared_codes(parts: int):
    """Arrow function over one part: the documents as they came, or the groups of different sets that share a code."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        payloads = [x.as_buffer() for x in table.column("payload")]
        if part < 0:
            rows = np.concatenate([np.frombuffer(b, _DOC) for b in payloads])
            return _rows(0, rows["second"], rows["fp"], 0, 0, rows["n"], np.zeros(len(rows), np.int64), rows["doc"], rows["valid"] == 0)
        heads, codes = [], []
        for b in payloads:
            n = int(np.frombuffer(b, "<i8", 1)[0])
            heads.append(np.frombuffer(b, _HEAD, n, 8))
            codes.append(np.frombuffer(b, np.uint8, offset=8 + n * _HEAD.itemsize).reshape(-1, 6))
        head, six = np.concatenate(heads), np.concatenate(codes)
        code = np.zeros((len(six), 8), np.uint8)
        code[:, :6] = six
        code = code.view(np.uint64).ravel()
        fps, node = np.unique(head["fp"], return_inverse=True)  # copies are one node
        node = np.repeat(node, head["times"])
        order = np.argsort(code, kind="stable")
        code, node = code[order], node[order]
        # Codes that occur once go first: nearly all.
        same = np.append(False, code[1:] == code[:-1])
        same[:-1] |= same[1:]
        code, node = code[same], node[same]
        order = np.lexsort((node, code))
        code, node = code[order], node[order]
        fresh = np.append(True, (code[1:] != code[:-1]) | (node[1:] != node[:-1]))[: len(code)]
        code, node = code[fresh], node[fresh]
        begins = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        size = np.diff(np.append(begins, len(code)))
        begins, size = begins[size > 1], size[size > 1]
        layout = part // 4096 // parts
        if not len(begins):
            return _rows(1, *[np.zeros(0, np.uint64)] * 2, layout, *[np.zeros(0, np.int64)] * 4, np.zeros(0, bool))
        member = node[ragged(begins, size)]
        # Groups of the same nodes are one group that counts several times.
        signed = np.add.reduceat(_mix(fps[member] + _U(layout)), np.cumsum(size) - size)
        gid, first, times = np.unique(signed, return_index=True, return_counts=True)
        begins, size = begins[first], size[first]
        member = node[ragged(begins, size)]
        any_head = np.zeros(len(fps), np.int64)
        any_head[np.searchsorted(fps, head["fp"])] = np.arange(len(head))
        own = head[any_head[member]]
        return _rows(1, np.repeat(gid, size), fps[member], layout, own["need"], own["n"], np.repeat(times, size), np.zeros(len(member), np.int64), np.ones(len(member), bool))

    return run


def _rows(kind, gid, node, layout, need, n, times, doc, no_doc) -> pa.Table:
    k = len(gid)
    full = lambda x, t: pa.array(np.broadcast_to(np.asarray(x), k).astype(t))
    return pa.Table.from_arrays(
        [
            full(kind, np.int8), pa.array(np.asarray(gid, np.uint64).view(np.int64)), pa.array(np.asarray(node, np.uint64).view(np.int64)),
            full(layout, np.int16), full(need, np.int32), full(n, np.int32), pa.array(np.asarray(times, np.int64)),
            pa.array(np.asarray(doc, np.int64), mask=np.asarray(no_doc, bool)),
        ],
        _NAMES,
    )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, hashes) of candidate texts; a text that is not the node's (an id with several texts) gives no row."""
    for batch in byte_slices(batches, "text", SKETCH_BYTES):
        h, upto = shingles(*text_parts(batch.column("text")))
        fp, _ = fingerprints(h, upto)
        node = batch.column("node").to_numpy(zero_copy_only=False)
        keep = np.flatnonzero(fp.view(np.int64) == node)
        data = [h[upto[i] : upto[i + 1]].tobytes() for i in keep]
        yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(data, pa.binary())], ["node", "hashes"])


def _bit_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, layout, bits): the parity sketch of a set in a layout, with some more bits than may differ."""
    layouts = Layouts()
    for batch in batches:
        out = []
        for layout, hashes in zip(batch.column("layout").to_pylist(), batch.column("hashes"), strict=True):
            h = np.frombuffer(hashes.as_buffer(), np.uint64)
            layouts.band(np.array([len(h) * 2]))
            wide = 64 * max(8, int(layouts.differ()[layout]) * SKETCH_BITS // 64 + 1)
            odd = np.bincount((h % _U(wide)).astype(np.int64), minlength=wide) & 1
            out.append(np.packbits(odd.astype(np.uint8)).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("layout"), pa.array(out, pa.binary())], ["node", "layout", "bits"])


def _near_sketches(percent: int):
    """Arrow function over a block of minor nodes and one of all nodes of a group: the pairs of different labels whose sizes and sketches let them link."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, label, n = (table.column(c).to_numpy() for c in ("node", "label", "n"))
        minor = table.column("minor").to_numpy(zero_copy_only=False)
        bits = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in table.column("bits")), np.uint64).reshape(len(node), -1)
        left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
        found = []
        step = max(1, (1 << 21) // max(1, len(right) * bits.shape[1]))
        for start in range(0, len(left), step):
            rows = left[start : start + step]
            fits = label[rows, None] != label[None, right]
            small, large = np.minimum(n[rows, None], n[None, right]), np.maximum(n[rows, None], n[None, right])
            fits &= small * 100 >= large * percent
            x, y = np.nonzero(fits)
            for part in range(0, len(x), 1 << 16):
                a, b = rows[x[part : part + (1 << 16)]], right[y[part : part + (1 << 16)]]
                differ = np.bitwise_count(bits[a] ^ bits[b]).sum(1, dtype=np.int64)
                near = differ * (100 + percent) <= (n[a].astype(np.int64) + n[b]) * (100 - percent)
                found.append((np.minimum(node[a], node[b])[near], np.maximum(node[a], node[b])[near]))
        a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        return pa.table([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def _open_groups(named: DataFrame) -> DataFrame:
    """Per group with several labels: its commonest label, and blocks of ``COMPARED`` for all of its nodes and for those of other labels."""
    per_label = named.groupBy("gid", "label").agg(F.count("*").alias("c"))
    of = per_label.groupBy("gid").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("members"))
    blocks = lambda c: F.ceil(c / COMPARED).cast("int")
    of = of.where("members > top.c")
    return of.select("gid", F.col("top.label").alias("major"), blocks(F.col("members")).alias("blocks"), blocks(F.col("members") - F.col("top.c")).alias("minors"))


def _meetings(named: DataFrame) -> DataFrame:
    """Every node outside its group's commonest label beside every node of the group: by (gid, i, j), block i of the former, block j of the latter."""
    rest = [c for c in named.columns if c not in ("major", "blocks", "minors")]
    block = lambda many: F.pmod(F.xxhash64("node"), many).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.col(many) - 1))
    left = named.where("label != major").select(*rest, F.lit(True).alias("minor"), block(F.col("minors")).alias("i"), every("blocks").alias("j"))
    right = named.select(*rest, F.lit(False).alias("minor"), every("minors").alias("i"), block(F.col("blocks")).alias("j"))
    return left.union(right)


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                a, b = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").mapInArrow(_linked(percent), "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge; label is the smallest node of its component.

    Each round takes the smallest label among neighbours and then that label's own label, so long chains
    halve; a round is one written table.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("new"), "label")
        step = written(step, "labels")
        labels = step.select("node", F.col("new").alias("label"))
        if step.where("new != label").isEmpty():
            return labels


def _core(groups: DataFrame) -> DataFrame:
    """Groups without the nodes that share fewer than ``need`` codes in every layout, and without groups of one."""
    for _ in range(2):
        enough = groups.groupBy("node", "layout").agg(F.sum("times").alias("shared"), F.max("need").alias("need")).where("shared >= need")
        groups = groups.join(enough.select("node", "layout"), ["node", "layout"])
        several = groups.groupBy("gid").agg(F.count("*").alias("members")).where("members > 1")
        groups = groups.drop("members").join(several, "gid")
    return groups


def _rarest(groups: DataFrame) -> DataFrame:
    """Of each node and layout, the memberships by which a link must show first.

    A node's codes that a linked node lacks are at most ``shared - need`` of those it shares with
    anyone. So, in one order of all groups, the first code that a linked pair has in common is
    among the first ``shared - need + 1`` of either node. Ordered by size, these are the rarest
    ones: a passage that many documents hold comes last.
    """
    own = Window.partitionBy("node", "layout")
    before = F.sum("times").over(own.orderBy("members", "gid").rowsBetween(Window.unboundedPreceding, -1))
    ranked = groups.withColumns({"before": F.coalesce(before, F.lit(0)), "shared": F.sum("times").over(own)})
    return ranked.where("before <= shared - need").drop("before", "shared", "members")


def _label(nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return nodes.withColumn("label", F.col("node"))
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def parts_for(docs: DataFrame) -> int:
    """Parts of one layout's code space: they follow the text's bytes and no setting."""
    total = docs.agg(F.sum(F.octet_length("text").cast("bigint")).alias("bytes")).first()["bytes"] or 0
    return max(4, -(-total // PART_BYTES))


def node_groups(docs: DataFrame, percent: int = PERCENT, parts: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, node (the set's fingerprint) and label of its component."""
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    parts = parts or parts_for(own)
    sent = own.mapInArrow(_sketch_rows(parts), "part bigint, payload binary")
    rows = written(sent.groupBy("part").applyInArrow(_shared_codes(parts), ROWS), "sketches")
    of_docs = rows.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "node", F.col("gid").alias("second"))
    nodes = of_docs.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("second").alias("s1"), F.max("second").alias("s2")
    )
    nodes = nodes.withColumn("first_id", F.when(F.col("s1") == F.col("s2"), F.col("first_id")).otherwise(F.raise_error(F.lit("two sets share a fingerprint"))))

    members = rows.where("kind = 1").groupBy("gid", "node", "layout").agg(
        F.sum("times").alias("times"), F.max("need").alias("need"), F.max("n").alias("n")
    )
    groups = _core(members)
    weight = groups.groupBy("node").agg(F.sum(F.col("times") * (F.col("members") - 1)).alias("central"))
    groups = written(groups.join(weight, "node"), "candidates")

    wanted = groups.select("node").distinct().join(nodes.select("node", "first_id"), "node").select("node", F.col("first_id").alias("doc_id"))
    wanted = written(wanted, "wanted")
    few = wanted.count() <= BROADCAST_IDS
    texts = own.join(F.broadcast(wanted) if few else wanted, "doc_id").select("node", "text")
    sets = written(texts.mapInArrow(_set_rows, "node bigint, hashes binary").dropDuplicates(["node"]), "sets")

    labels, edges, tried = None, None, None
    for _ in range(STARS):
        named = _label(groups, labels)
        centre = named.groupBy("gid").agg(
            F.max(F.struct("central", "node", "label")).alias("c"), F.min("label").alias("l1"), F.max("label").alias("l2")
        )
        centre = centre.where("l1 != l2").select("gid", F.col("c.node").alias("a"), F.col("c.label").alias("a_label"))
        pairs = named.join(centre, "gid").where("label != a_label").groupBy(F.col("node").alias("b"), "a").agg(F.sum("times").alias("times"))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = pairs.groupBy("b").agg(F.max(F.struct("times", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
        pairs = written(pairs, "stars")
        found = written(verify(pairs, sets, percent), "verified")
        tried = pairs if tried is None else tried.union(pairs)
        if not found.isEmpty():
            edges = found if edges is None else edges.union(found)
            labels = components(edges)

    named = _label(_rarest(groups), labels)
    named = written(named.join(_open_groups(named), "gid"), "open")
    bits = sets.join(named.select("node", "layout").distinct(), "node").mapInArrow(_bit_sketches, "node bigint, layout smallint, bits binary")
    met = named.join(bits, ["node", "layout"]).select("gid", "node", "label", "n", "bits", "major", "blocks", "minors")
    pairs = _meetings(met).groupBy("gid", "i", "j").applyInArrow(_near_sketches(percent), "a bigint, b bigint").distinct()
    pairs = pairs.join(tried, ["a", "b"], "left_anti")
    swapped = tried.select(F.col("b").alias("a"), F.col("a").alias("b"))
    pairs = written(pairs.join(swapped, ["a", "b"], "left_anti"), "open-pairs")
    found = written(verify(pairs, sets, percent), "verified")
    if not found.isEmpty():
        labels = components(found if edges is None else edges.union(found))

    ids = _label(nodes.select("node", "first_id"), labels)
    least = ids.groupBy("label").agg(F.min("first_id").alias("component_id"))
    ids = ids.join(least, "label").select("node", "component_id", "label")
    some = of_docs.where("n_shingles > 0 AND doc_id IS NOT NULL").join(ids, "node").select("doc_id", "n_shingles", "component_id", "node", "label")
    none = of_docs.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "node", F.lit(None).cast("bigint").alias("label"))
    return some.union(none).select("doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), "component_id", "node", "label")


def link_groups(docs: DataFrame, percent: int = PERCENT, parts: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id."""
    return node_groups(docs, percent, parts).select("doc_id", "n_shingles", "component_id")


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the fingerprint of their set; null where it is empty."""
    for batch in byte_slices(batches, "text", SKETCH_BYTES):
        h, upto = shingles(*text_parts(batch.column("text")))
        node = pa.array(fingerprints(h, upto)[0].view(np.int64), mask=np.diff(upto) == 0)
        yield pa.RecordBatch.from_arrays([batch.column("whole"), node], ["whole", "node"])


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, whole: of each component the document with the smallest id. Rows without words or id stay."""
    groups = written(node_groups(docs, percent), "groups")
    again = written(groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    drop = groups.where("component_id != doc_id").select("doc_id").union(again)
    few = drop.count() <= BROADCAST_IDS
    kept = docs.join(F.broadcast(drop) if few else drop, "doc_id", "left_anti").select(docs.columns)
    if again.isEmpty():
        return kept
    # An id with several rows may hold several texts: these are judged by their fingerprint, one row of each component stays.
    first = groups.where("component_id = doc_id AND label IS NOT NULL").join(again, "doc_id", "left_semi")
    first = first.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("first")).select("first.doc_id", "first.node")
    rows = docs.join(again, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("whole"), "text")
    schema = f"whole {rows.schema['whole'].dataType.simpleString()}, node bigint"
    rows = written(rows.mapInArrow(_fingerprint_rows, schema), "judged").select(F.col("whole.doc_id").cast("bigint").alias("doc_id"), "node", "whole")
    single = rows.join(first, ["doc_id", "node"], "left_semi").groupBy("doc_id", "node").agg(F.first("whole").alias("whole"))
    stay = single.select("whole").union(rows.where("node IS NULL").select("whole"))
    return kept.union(stay.select("whole.*").select(docs.columns))


#: The rows of ``link_groups`` over ``documents`` (whose ids are unique) in DuckDB's SQL, by brute force.
GROUPS_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
  FROM t
), n AS (
  SELECT t.doc_id, count(g) AS n FROM t LEFT JOIN s USING (doc_id) GROUP BY t.doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {PERCENT} * (a.n + b.n - c)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y
)
SELECT doc_id, CAST(max(n) AS BIGINT) AS n_shingles, min(y) AS component_id FROM n JOIN reach ON x = doc_id GROUP BY doc_id
"""
