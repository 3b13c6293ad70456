"""Divergence of sources within a language, by mergeable radix tries of terms.

Each partition counts its terms in byte tries, one for each language, whose leaves have counters by source and the number of documents. A
trie is kept as its leaves in UTF-8 order, and packed as what a walk meets: how many bytes a leaf shares with the one before, the label that
follows, and its counters. Tries are merged by merging their walks and adding up the counters of equal leaves. A task merges the tries of its
batches of texts until they have LEAVES leaves; then it packs them, cut where the first PREFIX bytes of terms change, and begins anew, so
its memory is bounded. The packed sub-tries of one prefix meet in one task and are merged. Prefixes with more than RANGE bytes of sub-tries
are merged in parts, whose leaves then meet in sorted ranges of prefixes. Merged sub-tries hold the terms that are in enough documents; they
are what the audit reads, in UTF-8 order, without another shuffle.

The audit never lists pairs of sources for a term that one of them lacks. With f(a, b) the value of a term, a pair's sum over all V terms is
    sum over terms of both of f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0), + sum over terms of a of f(a, b0) - f(a0, b0)
    + sum over terms of b of f(a0, b) - f(a0, b0), + V f(a0, b0),
where 0 marks the share of a term that is absent. The first sum is made in the traversal, in blocks of PAIRS that are added up before they
leave the task; the others from how many terms of a source have a share, and how many shares of absent terms there are. The traversal also
keeps each group's best terms so far. All arithmetic is in whole numbers.

Defined results. Null text, lang and source: empty. A group without terms has its pairs and no terms; a language without kept terms
gives pairs of value 0. Repeated rows count as often as they come; doc_id isn't read. Ties go by the item's UTF-8. An empty table gives no
rows. Extra columns are ignored. A sum beyond a long is an error.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.llm.common import checked_broadcast, documents, fits, written

LEAST, SMOOTH, TOP = 3, 1, 200
SHARE = 1_000_000_000
#: Leaves of a task's tries at which they are emptied, bytes of a prefix that tells sub-tries apart, packed bytes of sub-tries that one task
#: merges, and the most pairs of a block.
LEAVES, PREFIX, RANGE, PAIRS = 500_000, 2, 1 << 24, 1 << 20
_OTHER = bytes(b for b in range(128) if not chr(b).isalpha())
#: A-Z lower-cased, and a space for all that is in no term; bytes above ASCII are in terms.
_TERMS = bytes.maketrans(bytes(range(65, 91)) + _OTHER, bytes(range(97, 123)) + b" " * len(_OTHER))
#: Bytes of texts whose terms are told apart at once.
CHUNK = 1 << 22
LEAF = "lang string, term binary, docs long, source array<string>, n array<long>"


def words(data: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, by chunks."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= CHUNK else next((i for i in range(at + CHUNK, len(data)) if data[i] < 128 and not chr(data[i]).isalpha()), len(data))
        yield data[at:end].translate(_TERMS).split()
        at = end


def trie(texts: list[tuple[int, str, list[bytes]]], lang: str) -> pa.RecordBatch:
    """LEAF rows of the terms of some documents of a language, each with a number, a source and terms; a document may come in pieces."""
    told = pa.array([t for _, _, found in texts for t in found], pa.binary()).dictionary_encode()
    order = pc.sort_indices(told.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    leaf = rank[told.indices.to_numpy()]
    lens = [len(found) for _, _, found in texts]
    names = pa.array([source for _, source, _ in texts], pa.string()).dictionary_encode()
    key, n = np.unique(leaf << 32 | np.repeat(names.indices.to_numpy().astype(np.int64), lens), return_counts=True)
    of = np.unique(leaf << 32 | np.repeat(np.array([d for d, _, _ in texts], np.int64), lens)) >> 32
    offsets = np.searchsorted(key >> 32, np.arange(len(order) + 1))
    source = names.dictionary.take(pa.array(key & 0xFFFFFFFF))
    return listed(pa.array([lang] * len(order), pa.string()), told.dictionary.take(order), pa.array(np.bincount(of, minlength=len(order))), offsets, source, pa.array(n))


def raw(term: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where terms begin in their bytes, with an end behind the last, and the bytes."""
    _, offsets, data = term.buffers()
    return np.frombuffer(offsets, np.int32)[term.offset : term.offset + len(term) + 1].astype(np.int64), np.frombuffer(data or b"", np.uint8)


def shared(at: np.ndarray, data: np.ndarray) -> np.ndarray:
    """How many bytes each term has in common with the one before."""
    out, sizes = np.zeros(len(at) - 1, np.int64), np.diff(at)
    rows, k = np.arange(1, len(sizes)), 0
    while len(rows):
        rows = rows[(sizes[rows] > k) & (sizes[rows - 1] > k)]
        rows = rows[data[at[rows] + k] == data[at[rows - 1] + k]]
        out[rows] += 1
        k += 1
    return out


def segments(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes, bytes]]:
    """LEAF rows of one language as packed sub-tries: language, prefix, code."""
    at, data = raw(batch.column("term"))
    cuts = [0, *(np.flatnonzero(shared(at, data)[1:] < np.minimum(PREFIX, np.maximum(np.diff(at)[1:], np.diff(at)[:-1]))) + 1).tolist(), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            part = batch[a:b]
            yield part.column("lang")[0].as_py(), part.column("term")[0].as_py()[:PREFIX], packed(part)


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their n."""
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    return key[order][first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def packed(batch: pa.RecordBatch) -> bytes:
    """LEAF rows of one language, compressed: shared bytes, labels, documents, and counters, each a number in a list of sources with its count."""
    at, data = raw(batch.column("term"))
    same = shared(at, data)
    sizes = np.diff(at) - same
    label = data[np.repeat(at[:-1] + same, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
    told = batch.column("source").flatten().dictionary_encode()
    used, own = np.unique(told.indices.to_numpy(), return_inverse=True)
    names = json.dumps(told.dictionary.take(pa.array(used)).to_pylist()).encode()
    lengths = pc.list_value_length(batch.column("source")).to_numpy()
    numbers = ((same, "<i4"), (sizes, "<i4"), (batch.column("docs").to_numpy(), "<i8"), (lengths, "<i4"), (own, "<i4"), (batch.column("n").flatten().to_numpy(), "<i8"))
    parts = [*(x.astype(t).tobytes() for x, t in numbers), label.tobytes(), names]
    return zstandard.compress(struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts), 1)


def unpacked(lang: str, code: bytes) -> pa.RecordBatch:
    """LEAF rows of packed ones."""
    data = zstandard.decompress(code)
    ends = np.cumsum([64, *struct.unpack_from("<8q", data)])
    *numbers, label, names = (data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True))
    same, sizes, docs, lengths, own, n = (np.frombuffer(x, t) for x, t in zip(numbers, ("<i4", "<i4", "<i8", "<i4", "<i4", "<i8"), strict=True))
    terms, term, at = [], b"", 0
    for k, size in zip(same.tolist(), sizes.tolist(), strict=True):
        term = term[:k] + label[at : at + size]
        at += size
        terms.append(term)
    source = pa.array(json.loads(names), pa.string()).take(pa.array(own))
    return listed(pa.array([lang] * len(terms), pa.string()), pa.array(terms, pa.binary()), pa.array(docs), np.cumsum([0, *lengths]), source, pa.array(n))


def leaves(docs: DataFrame) -> DataFrame:
    """Packed sub-tries of each partition: lang, prefix, code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[int, str, list[bytes]]]] = {}  # by language, terms of texts
        tries: dict[str, list[pa.RecordBatch]] = {}  # by language, to be merged
        read = size = 0

        def count() -> None:
            nonlocal size
            for lang, texts in held.items():
                made = trie(texts, lang)
                tries.setdefault(lang, []).append(made)
                size += len(made)
            held.clear()

        def rows() -> Iterator[pa.RecordBatch]:
            for pieces in tries.values():
                lang, prefix, code = zip(*segments(collapsed(pieces)), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(prefix, pa.binary()), pa.array(code, pa.binary())], ["lang", "prefix", "code"])
            tries.clear()

        for batch in batches:
            for doc, (lang, source, text) in enumerate(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("t"), strict=True)):
                data = text.as_py()
                if len(data) > CHUNK:  # a trie for each chunk; a term counts its document once
                    pieces = [trie([(doc, source, found)], lang) for found in words(data) if found]
                    if pieces:
                        one = collapsed(pieces)
                        tries.setdefault(lang, []).append(one.set_column(2, "docs", pa.array(np.ones(len(one), np.int64))))
                        size += len(one)
                else:
                    for found in words(data):
                        if found:
                            held.setdefault(lang, []).append((doc, source, found))
                    read += len(data)
                if read >= CHUNK:
                    count()
                    read = 0
                if size >= LEAVES:
                    count()
                    for lang_, pieces in tries.items():
                        tries[lang_] = [collapsed(pieces)]
                    size = sum(len(t) for pieces in tries.values() for t in pieces)
                    if size >= LEAVES // 2:
                        yield from rows()
                        size = 0
            count()  # documents are numbered in their batch
        yield from rows()

    rows_ = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("t"))
    return rows_.mapInArrow(run, "lang string, prefix binary, code binary")


def listed(lang: pa.Array, term: pa.Array, docs: pa.Array, offsets: np.ndarray, source: pa.Array, n: pa.Array) -> pa.RecordBatch:
    """LEAF rows of flat counters."""
    offsets = offsets.astype(np.int32)
    return pa.RecordBatch.from_arrays([lang, term, docs, pa.ListArray.from_arrays(offsets, source), pa.ListArray.from_arrays(offsets, n)], ["lang", "term", "docs", "source", "n"])


def runs(batch: pa.RecordBatch) -> np.ndarray:
    """Where a term begins, in rows in order of lang and term."""
    new = np.ones(len(batch), bool)
    if len(batch) > 1:
        differs = lambda c: pc.not_equal(batch.column(c)[1:], batch.column(c)[:-1])
        new[1:] = pc.or_(differs("term"), differs("lang")).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def added(batch: pa.RecordBatch) -> pa.RecordBatch:
    """LEAF rows in order, those of one term as one."""
    begin = runs(batch)
    group = np.repeat(np.arange(len(begin)), np.diff([*begin, len(batch)]))
    lists = batch.column("source")
    group = np.repeat(group, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    names = lists.flatten().dictionary_encode()
    key = group * max(len(names.dictionary), 1) + names.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    n = np.add.reduceat(batch.column("n").flatten().to_numpy()[order], first) if len(first) else np.zeros(0, np.int64)
    at = order[first]
    offsets = np.searchsorted(group[at], np.arange(len(begin) + 1))
    docs = np.add.reduceat(batch.column("docs").to_numpy(), begin)
    pick = pa.array(begin)
    return listed(batch.column("lang").take(pick), batch.column("term").take(pick), pa.array(docs), offsets, names.dictionary.take(names.indices.take(pa.array(at))), pa.array(n))


def joined(*batches: pa.RecordBatch | None) -> pa.RecordBatch:
    return pa.Table.from_batches([b for b in batches if b is not None]).combine_chunks().to_batches()[0]


#: What merging gives. Of a merged sub-trie: its language, first term, code, and no source; of its terms: for each source n occurrences and
#: how many terms, with source null for all. Of a part, its code only, and kind part.
MERGED = "kind string, lang string, term binary, code binary, source string, n long, terms long"


def given(kind: str, lang: str, batch: pa.RecordBatch) -> pa.RecordBatch:
    """MERGED rows of LEAF rows of one language."""
    first = batch.column("term")[0].as_py()
    rows = [(kind, lang, first, packed(batch), None, None, None)]
    if kind == "whole":
        told, n = batch.column("source").flatten().dictionary_encode(), batch.column("n").flatten().to_numpy()
        at, sums = summed(told.indices.to_numpy().astype(np.int64), n)
        terms = np.bincount(told.indices.to_numpy())
        rows += [("total", lang, None, None, told.dictionary[i].as_py(), k, int(terms[i])) for i, k in zip(at.tolist(), sums.tolist(), strict=True)]
        rows.append(("total", lang, None, None, None, int(n.sum()), len(batch)))
    kinds = (pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], [f.split()[0] for f in MERGED.split(", ")])


def collapsed(pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
    """LEAF rows of one language in any order, those of one term as one, in order."""
    both = joined(*pieces)
    if len(pieces) == 1:
        return both
    return added(both.take(pc.sort_indices(both, [("term", "ascending")])))


def merged(segments: DataFrame, least: int = LEAST) -> DataFrame:
    """segments, a written table, merged by prefix: MERGED rows, of terms in at least least documents."""
    sizes = segments.groupBy("lang", "prefix").agg(F.ceil(F.sum(F.octet_length("code").cast("long")) / RANGE).alias("parts"))
    sizes = checked_broadcast(written(sizes, "prefixes"))
    rows = segments.join(sizes, ["lang", "prefix"]).withColumn("part", F.pmod(F.xxhash64("code"), F.col("parts")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pieces = None, []

        def done() -> Iterator[pa.RecordBatch]:
            lang, _, parts, _ = at
            batch = collapsed(pieces)
            if parts == 1:
                batch = batch.filter(pc.greater_equal(batch.column("docs"), least))
            for i in range(0, len(batch), LEAVES):
                yield given("whole" if parts == 1 else "part", lang, batch[i : i + LEAVES])

        for batch in batches:
            for key in zip(*(batch.column(c).to_pylist() for c in ("lang", "prefix", "parts", "part", "code")), strict=True):
                if key[:4] != at:
                    if at:
                        yield from done()
                    at, pieces = key[:4], []
                pieces.append(unpacked(key[0], key[4]))
                if sum(map(len, pieces)) >= LEAVES:
                    pieces = [collapsed(pieces)]
        if at:
            yield from done()

    keys = ["lang", "prefix", "part"]
    out = written(rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, MERGED), "merged")
    if out.where("kind = 'part'").isEmpty():
        return out
    return out.where("kind <> 'part'").unionByName(written(met(written(flat(out.where("kind = 'part'")), "parts"), least), "met"))


def flat(rows: DataFrame) -> DataFrame:
    """LEAF rows of MERGED rows with a code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, code in zip(batch.column("lang").to_pylist(), batch.column("code").to_pylist(), strict=True):
                yield unpacked(lang, code)

    return rows.select("lang", "code").mapInArrow(run, LEAF)


def met(rows: DataFrame, least: int) -> DataFrame:
    """LEAF rows of parts, a written table, merged in sorted ranges, of which a task holds one term at a time: MERGED rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None

        def enough(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            batch = batch.filter(pc.greater_equal(batch.column("docs"), least))
            langs = batch.column("lang").to_pylist()
            cuts = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1]), len(langs)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b > a:
                    yield given("whole", langs[a], batch[a:b])

        for batch in batches:
            if len(batch):
                both = added(joined(last, batch))
                yield from enough(both[:-1])
                last = both[len(both) - 1 :]
        if last is not None:
            yield from enough(last)

    return rows.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, MERGED)


def share(count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """1 + floor(SHARE * (count + SMOOTH) / size), by long division in two steps, so that longs do; larger sizes in whole numbers of any size."""
    if len(size) and int(size.max()) >= 9 * 10**13:
        count, size = count.astype(object), size.astype(object)
    whole, rest = (count + SMOOTH) // size, (count + SMOOTH) % size
    high, rest = rest * 100_000 // size, rest * 100_000 % size
    return (1 + whole * SHARE + high * 10_000 + rest * 10_000 // size).astype(np.int64)


def value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def share_sql(count: str, size: str) -> Column:
    return F.expr(f"1 + (cast({SHARE} as decimal(18,0)) * cast({count} + {SMOOTH} as decimal(20,0))) div {size}")


def value_sql(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


class Audit:
    """What a task gathers in its traversal: sums by pair of groups, and each group's best terms."""

    def __init__(self, top: int) -> None:
        self.top = top
        self.sums: dict[tuple[str, str, str], int] = {}
        self.shares: dict[tuple[int, int], int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object))

    def add(self, batch: pa.RecordBatch) -> None:
        """Rows of whole terms."""
        n, size, lang_n, lang_size = (batch.column(c).to_numpy() for c in ("n", "size", "lang_n", "lang_size"))
        pairs = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(*pairs, strict=True)], np.int64)
        p, p0, q = share(n, size), share(np.zeros_like(n), size), share(lang_n, lang_size)
        for g in np.unique(group).tolist():
            for v, c in zip(*(x.tolist() for x in np.unique(p[group == g], return_counts=True)), strict=True):
                self.shares[g, v] = self.shares.get((g, v), 0) + c
        over = np.flatnonzero(p > q)
        self._best(group[over], value(p[over], q[over]), np.array(batch.column("term").take(pa.array(over)).to_pylist(), object))
        begin = runs(batch)
        k = np.diff([*begin, len(batch)])
        start, k = np.repeat(begin, k), np.repeat(k, k)  # of each row's term
        done = np.concatenate([[0], np.cumsum(k)])
        at = 0
        while at < len(k):  # each row against all rows of its term, a block at a time
            end = max(int(np.searchsorted(done, done[at] + PAIRS, "right")) - 1, at + 1)
            a = np.repeat(np.arange(at, end), k[at:end])
            b = start[a] + np.arange(len(a)) - (done[a] - done[at])
            a, b = a[a != b], b[a != b]
            f = value(p[a], p[b]) - value(p[a], p0[b]) - value(p0[a], p[b]) + value(p0[a], p0[b])
            self._sum(group[a], group[b], f)
            at = end

    def _sum(self, a: np.ndarray, b: np.ndarray, f: np.ndarray) -> None:
        if not len(f):
            return
        names, key = list(self.groups), a * len(self.groups) + b
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        for i, v in zip(order[first].tolist(), np.add.reduceat(f[order], first).tolist(), strict=True):
            (lang, x), (_, y) = names[a[i]], names[b[i]]
            self.sums[lang, x, y] = self.sums.get((lang, x, y), 0) + v

    def _best(self, group: np.ndarray, f: np.ndarray, term: np.ndarray) -> None:
        group, f, term = (np.concatenate(x) for x in zip(self.best, (group, f, term), strict=True))
        order = np.lexsort((-f, group))  # stable: terms of one value stay in the traversal's order
        begin = np.flatnonzero(np.diff(group[order], prepend=-1))
        rank = np.arange(len(order)) - np.repeat(begin, np.diff([*begin, len(order)]))
        stay = np.sort(order[rank < self.top])
        self.best = group[stay], f[stay], term[stay]

    def taken(self, part: str) -> pa.RecordBatch:
        """What was gathered, as rows; it is gone from here."""
        if part == "pair":
            rows = [(*key, v) for key, v in self.sums.items()]
            self.sums = {}
        elif part == "share":
            names = list(self.groups)
            rows = [(*names[g], str(p), k) for (g, p), k in self.shares.items()]
            self.shares = {}
        else:
            names = list(self.groups)
            rows = [(*names[g], t, f) for g, f, t in zip(self.best[0].tolist(), self.best[1].tolist(), self.best[2], strict=True)]
        lang, source, item, f = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array([part] * len(rows), pa.string()), pa.array(item, pa.string()), pa.array(f, pa.int64())], ["lang", "source", "part", "item", "value"])


GATHERED = "lang string, source string, part string, item string, value long"


def told(audit: Audit, last: bool) -> Iterator[pa.RecordBatch]:
    """What audit holds that has grown large; at last all of it."""
    if last or len(audit.sums) >= PAIRS:
        yield audit.taken("pair")
    if last or len(audit.shares) >= PAIRS:
        yield audit.taken("share")
    if last:
        yield audit.taken("term")


def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
    """LEAF rows as a row for each counter: lang, term, source, n, lang_n."""
    n, lengths = batch.column("n").flatten().to_numpy(), pc.list_value_length(batch.column("n")).to_numpy()
    row = np.repeat(np.arange(len(batch)), lengths)
    lang_n = np.add.reduceat(n, np.cumsum([0, *lengths[:-1]]))
    pick = pa.array(row)
    return pa.RecordBatch.from_arrays([batch.column("lang").take(pick), batch.column("term").take(pick), batch.column("source").flatten(), pa.array(n), pa.array(lang_n[row])], ["lang", "term", "source", "n", "lang_n"])


def gathered(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The audit of merged sub-tries (MERGED rows with a code): GATHERED rows of each task. groups go to the tasks if they are proven few;
    else counters meet them in a join and are put in order again."""
    if fits(groups):
        sizes = {(r["lang"], r["source"]): (r["size"], r["lang_size"]) for r in groups.collect()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            audit, held = Audit(top), []

            def add() -> None:
                rows = joined(*held)
                of = np.array([sizes[g] for g in zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), strict=True)], np.int64)
                audit.add(rows.append_column("size", pa.array(of[:, 0])).append_column("lang_size", pa.array(of[:, 1])))
                held.clear()

            for batch in batches:
                for lang, code in zip(batch.column("lang").to_pylist(), batch.column("code").to_pylist(), strict=True):
                    held.append(spread(unpacked(lang, code)))
                    if sum(map(len, held)) >= LEAVES:
                        add()
                        yield from told(audit, False)
            if held:
                add()
            yield from told(audit, True)

        # merged sub-tries lie in no order; ties between tasks go by the item in the end, and in a task by the order of terms
        return kept.select("lang", "term", "code").sortWithinPartitions("lang", "term").mapInArrow(run, GATHERED)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, last = Audit(top), None
        for batch in batches:
            if len(batch):
                batch = joined(last, batch)
                cut = int(runs(batch)[-1])
                audit.add(batch[:cut])
                last = batch[cut:]
                yield from told(audit, False)
        if last is not None:
            audit.add(last)
        yield from told(audit, True)

    total = F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)
    rows = flat(kept).select("lang", "term", total.alias("lang_n"), F.explode(F.arrays_zip("source", "n")).alias("c")).select("lang", "term", "lang_n", "c.source", "c.n")
    sized = written(rows.join(groups.select("lang", "source", "size", "lang_size"), ["lang", "source"]), "sized")
    return sized.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(over, GATHERED)


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    kept = merged(written(leaves(docs), "leaves"), least)

    # totals of groups and languages
    names = [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    totals = kept.where("kind = 'total'")
    langs = totals.where("source is null").groupBy("lang").agg(F.sum("terms").alias("v"), F.sum("n").alias("lang_total"))
    totals = totals.where("source is not null").groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*names).distinct().join(langs, "lang", "left").join(totals, ["lang", "source"], "left").na.fill(0)
    size = (F.col("total") + SMOOTH * F.col("v")).alias("size")
    groups = written(groups.select("lang", "source", "v", size, (F.col("lang_total") + SMOOTH * F.col("v")).alias("lang_size")), "groups")

    # the traversal
    found = written(gathered(kept.where("code is not null"), groups, top), "audit")
    groups = groups.withColumn("p0", F.when(F.col("size") > 0, share_sql("0", "size")).otherwise(F.lit(1)))

    # terms of one of a pair against the other's absent ones: sums for each of the few shares of absent terms
    shares = found.where("part = 'share'").groupBy("lang", "source", F.col("item").cast("long").alias("p")).agg(F.sum("value").alias("k"))
    shares = shares.join(checked_broadcast(groups.select("lang", "source", "p0")), ["lang", "source"])
    absent = groups.select("lang", F.col("p0").alias("other")).distinct()
    wide = lambda c: F.sum(F.col("k").cast("decimal(20,0)") * c.cast("decimal(20,0)"))
    here, there = value_sql("p", "other") - value_sql("p0", "other"), value_sql("other", "p") - value_sql("other", "p0")
    one = shares.join(absent, "lang").groupBy("lang", "source", "other").agg(wide(here).alias("here"), wide(there).alias("there"))
    one = written(one, "absent")

    a, b = groups.select("lang", "source", "v", F.col("p0").alias("pa")), groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("pb"))
    pairs = a.join(b, "lang").where("source <> item")
    pairs = pairs.join(one.select("lang", "source", F.col("other").alias("pb"), "here"), ["lang", "source", "pb"], "left")
    pairs = pairs.join(one.select("lang", F.col("source").alias("item"), F.col("other").alias("pa"), "there"), ["lang", "item", "pa"], "left")
    both = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("both"))
    pairs = pairs.join(both, ["lang", "source", "item"], "left")
    base = F.col("v").cast("decimal(20,0)") * value_sql("pa", "pb").cast("decimal(18,0)")
    total = sum((F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)") for c in ("here", "there", "both")), base)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", total.cast("long").alias("value")).select("*", rank)
    terms = found.where("part = 'term'").select("*", rank).where(F.col("rank") <= top)
    return out.unionByName(terms)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


ORACLE = """
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
kept AS (SELECT lang, term, count(*) AS lang_n FROM d GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 3),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
n AS (SELECT lang, source, term, count(*) AS n FROM d SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM kept GROUP BY 1),
totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM groups g LEFT JOIN n USING (lang, source) GROUP BY 1, 2),
shares AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (g.total + v) AS p, 1 + (1000000000::HUGEINT * (lang_n + 1)) // (l.total + v) AS q
  FROM totals g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""
