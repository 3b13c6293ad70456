"""A language model in an Elias-Fano n-gram trie, trained and queried over all documents.

The trie. Level one holds all training words, sorted by 64-bit hash (a word's number is its rank), with exact counts as a
monotone running sum. Level two holds all pairs of words, level three all triples: none is dropped. A level of n-grams has
its contexts, monotone pointers to each context's successors, and the successors' numbers, which are raised above
those of the context before, so that they are monotone too. An n-gram is found by a successor search for its last
word, relative to where its context's stretch starts. All sequences are Elias-Fano coded; a byte holds an n-gram's smoothed
log probability, two its backoff weight as a context.

Smoothing: add one for words, Dirichlet priors above: p(w | c) = (n(c, w) + mu p(w | shorter c)) / (n(c) + mu), which sums to
one over all words and one unknown. A context found n times thus leaves mu / (n + mu) to the shorter one. The end symbol is also
the context of the first word; a triple begins inside its document.

Shards. Each level is cut into shards that are made, memory-mapped and queried by one task each; no task, executor or
driver holds a whole level. A word's shard is a range of hashes. A pair's is a hash of its first word and, if that was found more than SPLIT
times, of one of so many parts of its successors; a triple's is that of its pair, again with the parts of a frequent
pair's successors. So a word or pair that begins a third of all n-grams is spread, and whoever asks knows where.

Runs. Documents are dealt into runs of about RUN tokens. For each level, a run sends each shard one coded list of its distinct
n-grams with their counts in training documents; the shard sums the lists of all runs, builds its part of
the level, and answers each list by searching that part: where an n-gram is, its probability and weight.
Answers of one level tell a run which shards to ask for the next. So texts are read once, and each level costs one exchange of
coded lists, which grows with the corpus.

Defined results. Null text counts as empty: one token, the end. A null doc_id counts as empty text for its
remainder, so the document trains. With no training documents all counts are 0, N = V = 0. Repeated rows count each. A
text of any length is read in stretches of PIECE bytes that end at white space, which keep two tokens of
context. An empty table gives no rows; extra columns are ignored. More than 2**32 distinct words are refused.
Words are told apart by their XXH64; two of one hash would be one word.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import documents, remove, text_of, written, written_at
from quire.llm.eliasfano import EliasFano, mapped, received, sent

END = b""
#: Tokens of a run, about; bytes of a stretch of a long text.
RUN, PIECE = 750_000, 1_000_000
#: Listed n-grams for each shard of a level, about; a context found more often than SPLIT is cut into parts.
SHARD = 2_000_000
SPLIT = 1_000_000
#: The weight of the shorter context, for pairs and triples.
MU = (200.0, 30.0)
#: A byte stands for a log10 between -10 and 0, two bytes for one between -12 and 0.
_P, _W = 10.0 / 254, 12.0 / 65535
_space = re.compile(rb"[\x20\x09-\x0D]")
#: What a row of a run's table is: the run, its words, or the answers for one level.
_RUN, _WORDS, _PAIRS, _TRIPLES = 0, 1, 2, 3


def tokens(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def _stretches(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The tokens of a text, stretch by stretch; the last ends with END."""
    start = 0
    while len(data) - start > piece and (m := _space.search(data, start + piece)):
        yield data[start : m.start()].split()
        start = m.end()
    yield [*data[start:].split(), END]


def _code(log: np.ndarray) -> np.ndarray:
    """From 1 to 255; 0 is left for what is not there."""
    return np.clip(np.round(-log / _P) + 1, 1, 255).astype(np.uint8)


def _log(code: np.ndarray) -> np.ndarray:
    return (code.astype(np.int64) - 1) * -_P


def _weight_code(log: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-log / _W), 0, 65535).astype("<u2")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A hash of 64-bit numbers."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


def _dealt(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _narrow(ids: np.ndarray, width: int) -> list[np.ndarray]:
    """Numbers below width as bytes: the 255 commonest by their place among them, the others in planes of bytes."""
    common = np.argsort(-np.bincount(ids, minlength=width), kind="stable")[:255]
    place = np.full(width, 255, np.uint8)
    place[common] = np.arange(len(common))
    small = place[ids]
    planes = np.ascontiguousarray(ids[small == 255].astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return [common.astype("<u4"), small, *planes]


def _widened(common: np.ndarray, small: np.ndarray, *planes: np.ndarray) -> np.ndarray:
    ids = np.append(common, np.zeros(256 - len(common), "<u4"))[small].astype(np.int64)
    ids[small == 255] = np.ascontiguousarray(np.stack(planes, 1)).view("<u4").ravel()
    return ids


def _split(run: int, piece: int):
    """Two rows for each run: its tokens as numbers of its distinct words in the order of their hashes, with the documents; and these
    hashes with training counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        ids, docs, sizes, leads, held, size = [], [], [], [], [], 0

        def out() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), np.uint64, len(index))
            order = np.argsort(hashes)
            local = np.concatenate(ids)
            skip = np.zeros(len(local), bool)
            cut = np.concatenate([[0], np.cumsum(sizes)])
            for k in np.flatnonzero(leads):
                skip[cut[k] : cut[k] + leads[k]] = True
            train = ~skip & ~np.repeat(np.array(held, bool), sizes)
            trained = np.bincount(local[train], minlength=len(index))
            rank = np.empty(len(index), np.int64)
            rank[order] = np.arange(len(index))
            body = sent([*_narrow(rank[local], len(index)), np.array(sizes, "<u4"), np.array(leads, np.uint8), np.array(held, np.uint8), np.array([rank[0], len(index)], "<u4")])
            words = sent([*EliasFano.coded(hashes[order]), trained[order].astype("<u4")])
            of = pa.ListArray.from_arrays(pa.array([0, len(docs), len(docs)], pa.int32()), pa.concat_arrays(docs))
            return pa.RecordBatch.from_arrays([pa.array([number, number]), pa.array([_RUN, _WORDS], pa.int32()), pa.array([len(local), len(index)], pa.int64()), pa.array([body, words], pa.binary()), of], ["run", "kind", "size", "body", "docs"])

        index[END]
        for batch in batches:
            rows, texts = batch.column("doc"), batch.column("t")
            if isinstance(rows, pa.ChunkedArray):
                rows = rows.combine_chunks()
            flags = rows.field("held_out").to_pylist()
            for i in range(batch.num_rows):
                lead: list[bytes] = []
                for found in _stretches(texts[i].as_buffer().to_pybytes().lower(), piece):
                    if not found:
                        continue
                    found = lead + found
                    ids.append(np.fromiter(map(index.__getitem__, found), np.int64, len(found)))
                    docs.append(rows.slice(i, 1))
                    sizes.append(len(found))
                    leads.append(len(lead))
                    held.append(flags[i])
                    size += len(found)
                    lead = [END, *found][-2:]
                    if size >= run:
                        yield out()
                        number += 1
                        index.clear()
                        index[END]
                        ids, docs, sizes, leads, held, size = [], [], [], [], [], 0
        if docs:
            yield out()

    return split


def _by(shard: np.ndarray) -> Iterator[np.ndarray]:
    """The places of each shard's entries, in ascending order of shards."""
    order = np.argsort(shard, kind="stable")
    yield from (p for p in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(p))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in ascending order, the place of each key there, some place that has each)."""
    values, place = np.unique(keys, return_inverse=True)
    some = np.empty(len(values), np.int64)
    some[place] = np.arange(len(keys))
    return values, place, some


def _lists(run: int, shard: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """A run's lists, one for each shard that it has a key for. keys: ascending inside a shard."""
    parts = list(_by(shard))
    bodies = [sent([*EliasFano.coded(keys[p]), *[m[p] for m in more]]) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array([int(shard[p[0]]) for p in parts], pa.int64()), pa.array([run] * len(parts), pa.int64()), pa.array(bodies, pa.binary())], ["shard", "run", "body"])


def _word_lists(shards: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, body in zip(batch.column("run").to_pylist(), batch.column("body"), strict=True):
                *coded, counts = received(body.as_py())
                hashes = EliasFano(coded).all()
                yield _lists(run, _dealt(hashes, shards), hashes, counts)

    return deal


def _summed(table: pa.Table) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """(lists, distinct keys, their counts, where each is first); a list: run, keys, the other arrays."""
    lists = []
    for run, raw in zip(table.column("run").to_pylist(), table.column("body"), strict=True):
        arrays = received(raw.as_py())
        lists.append((run, EliasFano(arrays[:3]).all(), arrays[3:]))
    keys = np.concatenate([k for _, k, _ in lists])
    counts = np.concatenate([m[0] for _, _, m in lists]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
    return lists, keys[order[first]], np.add.reduceat(counts[order], first), order[first]


def _answer(key, lists: list[tuple], bodies: list[bytes], size: int, total: int) -> pa.Table:
    n = len(lists)
    columns = [pa.array([key] * n, pa.int64()), pa.array([x[0] for x in lists], pa.int64()), pa.array(bodies, pa.binary()), pa.array([size] * n, pa.int64()), pa.array([total] * n, pa.int64())]
    return pa.table(columns, ["shard", "run", "body", "size", "total"])


_ANSWER = "shard long, run long, body binary, size long, total long"


def _word_level(key, table):  # without types: Spark reads them
    """A shard of the first level, and its answers: each word's rank in the shard and count."""
    lists, words, counts, _ = _summed(table)
    words, counts = words[counts > 0], counts[counts > 0]
    level = mapped([*EliasFano.coded(words), *EliasFano.coded(np.concatenate([[0], np.cumsum(counts)]))])
    hashes, upto = EliasFano(level[:3]), EliasFano(level[3:])
    bodies = []
    for _, asked, _ in lists:
        rank, there = hashes.successor(asked)
        n = np.zeros(len(asked), np.uint64)
        n[there] = upto[rank[there] + 1] - upto[rank[there]]
        bodies.append(sent([*EliasFano.coded(rank), n]))
    return _answer(key[0].as_py(), lists, bodies, len(words), int(counts.sum()))


class Level:
    """A shard of pairs or triples: for each context its successors, with codes. keys: ascending, context << 32 | word."""

    def __init__(self, keys: np.ndarray, *codes: np.ndarray) -> None:
        context, word = keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)
        starts = np.flatnonzero(np.diff(context, prepend=~context[:1]))
        ends = np.append(starts[1:], len(keys))
        raised = np.concatenate([[0], np.cumsum(word[ends - 1] + np.uint64(1))]).astype(np.uint64)
        words = word + np.repeat(raised[:-1], ends - starts)
        arrays = mapped([*EliasFano.coded(context[starts]), *EliasFano.coded(np.append(starts, len(keys))), *EliasFano.coded(words), *codes])
        self.contexts, self.pointers, self.words = (EliasFano(arrays[k : k + 3]) for k in (0, 3, 6))
        self.codes = arrays[9:]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each n-gram in the level, whether it is there)."""
        asked = keys >> np.uint64(32)
        head = np.flatnonzero(np.diff(asked, prepend=~asked[:1]))
        context, known = self.contexts.successor(asked[head])
        context[~known] = 0
        start, end = self.pointers[context].astype(np.int64), self.pointers[context + 1].astype(np.int64)
        raised = np.where(start > 0, self.words[np.maximum(start - 1, 0)].astype(np.int64) + 1, 0)
        many = np.diff(np.append(head, len(asked)))
        place, there = self.words.successor(np.repeat(raised, many).astype(np.uint64) + (keys & np.uint64(0xFFFFFFFF)))
        return place, there & (place < np.repeat(end, many)) & np.repeat(known, many)


def _context_counts(contexts: np.ndarray, counts: np.ndarray, weight: np.ndarray, mu: float) -> np.ndarray:
    """How often the context of each n-gram is found: the sum over its successors, which are all in this shard, unless
    it is cut into parts; then the lists say it as a weight."""
    starts = np.flatnonzero(np.diff(contexts, prepend=~contexts[:1]))
    many = np.diff(np.append(starts, len(contexts)))
    n = np.repeat(np.add.reduceat(counts, starts).astype(float), many)
    return np.where(weight > 0, mu * (10.0 ** (weight * _W) - 1), n)


def _ngram_level(mu: float, next_mu: float | None, bits: int):
    """mu: of this level; next_mu: of the next one, None for the last. bits: of a word's number in a list's keys."""
    wide = lambda keys: keys >> np.uint64(bits) << np.uint64(32) | keys & np.uint64((1 << bits) - 1)

    def build(key, table):  # without types: Spark reads them
        """A shard of n-grams, and its answers: where each one is among those of the shard, its probability and weight."""
        lists, keys, counts, first = _summed(table)
        lower, weight = (np.concatenate([m[k] for _, _, m in lists])[first] for k in (1, 2))
        kept = counts > 0
        keys, counts, lower, weight = (x[kept] for x in (keys, counts, lower, weight))
        own, level = np.zeros(0, "<u2"), None
        if len(keys):
            n = _context_counts(keys >> np.uint64(bits), counts, weight, mu)
            p = _code(np.log10((counts + mu * 10.0 ** _log(lower)) / (n + mu)))
            own = _weight_code(np.log10(next_mu / (counts + next_mu))) if next_mu else own
            level = Level(wide(keys), p, own)
        bodies = []
        for _, asked, _ in lists:
            code, place, weights = np.zeros(len(asked), np.uint8), np.zeros(0, np.int64), own[:0]
            if level:
                at, there = level.find(wide(asked))
                code[there] = level.codes[0][at[there]]
                if next_mu:
                    place = at[there]
                    weights = level.codes[1][place]
            bodies.append(sent([*EliasFano.coded(place), code, weights]))
        return _answer(key[0].as_py(), lists, bodies, len(keys), int(counts.sum()))

    return build


class Facts:
    """What all runs are told: sums over the first level and numbers of shards."""

    def __init__(self, total: int, distinct: int, base: dict[int, int], shards: int, split: int) -> None:
        self.total, self.distinct, self.base, self.shards, self.split = total, distinct, base, shards, split
        self.bits = max(distinct.bit_length(), 1)


class Run:
    """A run's tokens with the answers that it has so far. Words, pairs and triples are numbered inside the run."""

    def __init__(self, table: pa.Table, facts: Facts) -> None:
        self.facts = facts
        self.last = "docs" in table.column_names
        kinds, shards = table.column("kind").to_numpy(), table.column("shard").to_numpy()
        body = lambda i: received(table.column("body")[int(i)].as_py())
        answers = lambda kind: ((int(shards[i]), body(i)) for i in sorted(np.flatnonzero(kinds == kind), key=lambda i: shards[i]))
        own = int(np.flatnonzero(kinds == _RUN)[0])
        self.number = table.column("run")[own].as_py()
        self.documents = table.column("docs")[own].values if self.last else None
        *ids, sizes, leads, held, (end, self.width) = body(own)
        self.ids, self.width = _widened(*ids), int(self.width)
        self.cut = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
        self.start = np.zeros(len(self.ids), bool)
        self.start[self.cut[:-1]] = True
        self.skip = np.zeros(len(self.ids), bool)
        for k in np.flatnonzero(leads):
            self.skip[self.cut[k] : self.cut[k] + leads[k]] = True
        self.train = (~self.skip & ~np.repeat(held.astype(bool), sizes)).astype(float)
        self.word, self.count = np.zeros(self.width, np.uint64), np.zeros(self.width, np.int64)
        at = 0
        for shard, (*coded, n) in answers(_WORDS):
            self.word[at : at + len(n)] = EliasFano(coded).all() + np.uint64(facts.base[shard])
            self.count[at : at + len(n)] = n
            at += len(n)
        self.base = np.log10((self.count + 1) / (facts.total + facts.distinct + 1))
        before = np.append(self.ids[:1], self.ids[:-1])
        before[self.start] = end
        pairs, self.pair, _ = _distinct(before * self.width + self.ids)
        self.a, self.b = pairs // self.width, pairs % self.width
        self.pair_asked = np.flatnonzero((self.count[self.a] > 0) & (self.count[self.b] > 0))
        a, b = self.a[self.pair_asked], self.b[self.pair_asked]
        self.pair_parts = np.maximum(-(-self.count[a] // facts.split), 1)
        part = _mixed(self.word[b]) % self.pair_parts.astype(np.uint64)
        self.pair_shard = _dealt(_mixed(self.word[a] << np.uint64(24) ^ part), facts.shards)
        if (kinds == _PAIRS).any():
            self._triples(answers)

    def pair_lists(self) -> pa.RecordBatch:
        a, b = self.a[self.pair_asked], self.b[self.pair_asked]
        counts = np.bincount(self.pair, self.train, len(self.a))[self.pair_asked].astype("<u4")
        weight = np.where(self.pair_parts > 1, _weight_code(np.log10(MU[0] / (self.count[a] + MU[0]))), 0).astype("<u2")
        return _lists(self.number, self.pair_shard, self.word[a] << np.uint64(self.facts.bits) | self.word[b], counts, _code(self.base[b]), weight)

    def _triples(self, answers) -> None:
        code, weight, rank = np.zeros(len(self.a), np.uint8), np.zeros(len(self.a), "<u2"), np.zeros(len(self.a), np.uint64)
        of = np.zeros(len(self.a), np.int64)
        of[self.pair_asked] = self.pair_shard
        for part, (_, (*coded, codes, weights)) in zip(_by(self.pair_shard), answers(_PAIRS), strict=True):
            at = self.pair_asked[part]
            code[at] = codes
            there = at[codes > 0]
            weight[there], rank[there] = weights, EliasFano(coded).all()
        self.pair_log = np.where(code > 0, _log(code), np.log10(MU[0] / (self.count[self.a] + MU[0])) + self.base[self.b])
        self.later = np.flatnonzero(~self.start)
        triples, self.triple, some = _distinct(self.pair[self.later - 1] * self.width + self.ids[self.later])
        self.context, last = triples // self.width, triples % self.width
        self.lower = self.pair_log[self.pair[self.later[some]]]
        self.weight = weight
        self.asked = np.flatnonzero((code[self.context] > 0) & (self.count[last] > 0))
        context = self.context[self.asked]
        found = MU[1] * (10.0 ** (weight[context] * _W) - 1)
        parts = np.maximum(np.ceil(found / self.facts.split), 1).astype(np.uint64)
        part = _mixed(self.word[last[self.asked]]) % parts
        self.parts_weight = np.where(parts > 1, weight[context], 0).astype("<u2")
        self.shard = of[context] + self.facts.shards * part.astype(np.int64)
        self.keys = rank[context] << np.uint64(self.facts.bits) | self.word[last[self.asked]]
        self.triple_code = np.zeros(len(triples), np.uint8)
        if self.last:
            for own, (_, (*_, codes, _)) in zip(_by(self.shard), answers(_TRIPLES), strict=True):
                self.triple_code[self.asked[own]] = codes

    def triple_lists(self) -> pa.RecordBatch:
        counts = np.bincount(self.triple, self.train[self.later], len(self.context))[self.asked].astype("<u4")
        return _lists(self.number, self.shard, self.keys, counts, _code(self.lower[self.asked]), self.parts_weight)

    def scores(self) -> pa.Table:
        log = self.pair_log[self.pair]
        own = np.where(self.triple_code > 0, _log(self.triple_code), self.lower - self.weight[self.context] * _W)
        log[self.later] = own[self.triple]
        scored = (~self.skip).astype(float)
        sums = [np.add.reduceat(x * scored, self.cut[:-1]) for x in (np.ones(len(log)), self.count[self.ids] > 0, self.base[self.ids], log)]
        columns = [self.documents, *[pa.array(x.astype(np.int64)) for x in sums[:2]], *[pa.array(x) for x in sums[2:]]]
        return pa.table(columns, ["doc", "n_tokens", "n_known", "base_score", "score"])


def _pair_lists(facts: Facts):
    return lambda key, table: pa.Table.from_batches([Run(table, facts).pair_lists()])


def _triple_lists(facts: Facts):
    return lambda key, table: pa.Table.from_batches([Run(table, facts).triple_lists()])


def _scores(facts: Facts):
    return lambda key, table: Run(table, facts).scores()


_LIST = "shard long, run long, body binary"


def scored(docs: DataFrame, modulus: int = 7, held: int = 2, run: int = RUN, piece: int = PIECE, shard: int = SHARD, split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. run, piece, shard and split
    say how the work is cut, whatever which the result is the same."""
    out = (F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % modulus) == held
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"), out.alias("held_out")).alias("doc"), text_of(docs).alias("t"))
    shape = rows.select(F.lit(0).cast("long").alias("run"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("size"), F.lit(b"").alias("body"), F.array("doc").alias("docs")).schema
    runs, path = written_at(rows.mapInArrow(_split(run, piece), shape), "lm-runs", by="kind")
    size = {r["kind"]: r["n"] for r in runs.groupBy("kind").agg(F.sum("size").alias("n")).collect()}
    shards = {k: max(16, size.get(k, 0) // shard) for k in (_RUN, _WORDS)}
    lists = runs.where(F.col("kind") == _WORDS).select("run", "body").mapInArrow(_word_lists(shards[_WORDS]), _LIST)
    words = written(lists.groupBy("shard").applyInArrow(_word_level, _ANSWER), "lm-words")
    remove(docs.sparkSession, f"{path}/kind={_WORDS}")
    level = words.groupBy("shard").agg(F.max("size").alias("size"), F.max("total").alias("total")).orderBy("shard").collect()  # one row a shard
    base, distinct = {}, 0
    for r in level:
        base[r["shard"]] = distinct
        distinct += r["size"]
    if distinct >= 1 << 32:
        raise ValueError("a model has at most 2**32 distinct words")
    facts = Facts(sum(r["total"] for r in level), distinct, base, shards[_RUN], split)
    named = lambda df, kind: df.select("run", F.lit(kind).alias("kind"), "shard", "body")
    own = runs.where(F.col("kind") == _RUN).withColumn("shard", F.lit(-1).cast("long"))
    answers = named(words, _WORDS)
    state = named(own, _RUN).unionByName(answers)
    lists = state.groupBy("run").applyInArrow(_pair_lists(facts), _LIST)
    pairs = written(lists.groupBy("shard").applyInArrow(_ngram_level(*MU, facts.bits), _ANSWER), "lm-pairs")
    answers = answers.unionByName(named(pairs, _PAIRS))
    state = named(own, _RUN).unionByName(answers)
    lists = state.groupBy("run").applyInArrow(_triple_lists(facts), _LIST)
    triples = written(lists.groupBy("shard").applyInArrow(_ngram_level(MU[1], None, facts.bits), _ANSWER), "lm-triples")
    answers = answers.unionByName(named(triples, _TRIPLES)).withColumn("docs", F.lit(None).cast(shape["docs"].dataType))
    state = answers.unionByName(own.select(*answers.columns))
    schema = runs.select(F.explode("docs").alias("doc")).schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)
    out = state.groupBy("run").applyInArrow(_scores(facts), schema)
    # a long text's stretches are summed
    out = out.groupBy("doc.row").agg(F.first("doc").alias("doc"), *[F.sum(c).alias(c) for c in schema.names[1:]])
    return out.select("doc.doc_id", "doc.held_out", "n_tokens", "n_known", F.lit(facts.total).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir))
