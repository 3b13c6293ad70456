"""Byte-level BPE encoding and decoding of whole texts by a queue of merge ranks.

Texts are cut into pre-tokens by the pattern. A queue with a bucket for each merge rank holds the places of pairs in a linked list of
tokens; a hierarchy of bitmaps over the buckets, WIDE bits to a word, gives the least rank by find-first-set on each level. An entry whose
pair has changed is stale and skipped. A merge touches its two neighbours only, so a pre-token takes a time in proportion to its length,
and very long ones are as cheap a byte as short ones. Many pre-tokens share one list and one queue, and those seen before are looked up
in bounded tables.

Ids are unsigned 32-bit numbers in little-endian order, one after another, as binary. Rows go on in batches of about RUN_BYTES.

Defined results. Null text: empty, no ids. Null ids decode to empty bytes. Repeated rows, ties and null ids of documents are rows like
any other. An empty table gives no rows. Extra columns, whatever their names, are ignored. Ids that the file doesn't have are an error.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.bpe import KNOWN, _known, parts
from quire.llm.common import documents, text_of

RUN_BYTES = 4_000_000
#: The most pre-tokens in each of two tables of those seen, and the most characters of one. A full young table takes the old one's place.
SEEN, SEEN_CHARS = 200_000, 64
#: Characters whose pre-tokens are looked up and merged at once, about.
UNIT = 2_000_000
#: A byte that UTF-8 never has.
STOP = b"\xff"
#: Bits of a bitmap's word, and of an index within one.
WIDE, SHIFT, MASK = 256, 8, 255


class RankQueue:
    """Buckets of places by rank, and two bitmaps over them: a bit for each rank, WIDE to a word, and a bit for each word."""

    def __init__(self, ranks: int) -> None:
        self.buckets: list[list[int] | None] = [None] * (ranks + 1)
        self.words = [0] * ((ranks >> SHIFT) + 1)
        self.top = 0

    def put(self, rank: int, places: list[int]) -> None:
        """places for a rank that has none."""
        self.buckets[rank] = places
        self.words[rank >> SHIFT] |= 1 << (rank & MASK)
        self.top |= 1 << (rank >> SHIFT)

    def take(self) -> tuple[int, list[int]]:
        """The least rank, by find-first-set on both levels, and its places in order; they leave the queue."""
        word = (self.top & -self.top).bit_length() - 1
        low = self.words[word]
        rank = word << SHIFT | (low & -low).bit_length() - 1
        low &= low - 1
        self.words[word] = low
        if not low:
            self.top &= self.top - 1
        places, self.buckets[rank] = self.buckets[rank], None
        places.sort()
        return rank, places


def outside(kind: str) -> str:
    """Characters that the regex library counts to a class and tiktoken doesn't, as ranges of a class: their Unicode versions differ."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    probe = tiktoken.Encoding("probe", pat_str=kind, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    own = set(bytes(probe.encode_ordinary(every)).decode())
    odd = sorted(ord(c) for c in set(regex.findall(kind, every)) - own)
    starts = [a for i, a in enumerate(odd) if not i or odd[i - 1] != a - 1]
    ends = [a for i, a in enumerate(odd) if i + 1 == len(odd) or odd[i + 1] != a + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends, strict=True))


def spelled(pattern: str, inner: dict[str, str]) -> str:
    """pattern with classes such as \\s written as what inner has for them within brackets; \\S is what \\s is not."""
    open_ = False

    def one(m: re.Match) -> str:
        nonlocal open_
        at = m[0]
        if at in ("[", "[^", "]"):
            open_ = at != "]"
            return at
        if at == "\\S":
            return f"[^{inner.get('\\s', '\\s')}]"
        known = inner.get(at, at)
        return known if open_ else f"[{known}]"

    return re.sub(r"\[\^?|\]|\\p\{\w+\}|\\s|\\S", one, pattern)


def plain(pattern: str) -> Callable[[str], list[str]]:
    """The pattern for texts of KNOWN characters alone, where both libraries' classes are the same: spelled out for the standard library,
    which takes a third of the time."""
    known = re.findall(f"[{KNOWN}]", "".join(map(chr, range(0xD800))))
    inner = {kind: "".join(re.escape(c) for c in known if regex.match(kind, c)) for kind in {*re.findall(r"\\p\{\w+\}", pattern), r"\s"}}
    return re.compile(spelled(pattern, inner)).findall


def full(pattern: str) -> Callable[[str], list[str]]:
    """The pattern for any text, with tiktoken's classes."""
    odd = {kind: outside(kind) for kind in re.findall(r"\\p\{\w+\}", pattern)}
    return regex.compile(spelled(pattern, {kind: f"[{kind}--[{x}]]" if x else kind for kind, x in odd.items()}), regex.V1).findall


class Ranks:
    """A file of ranks, with its encoder and decoder."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = pattern
        self.split, self.split_any = plain(pattern), None
        self.queue = RankQueue(max(self.tokens))
        self.first = np.full(1 << 16, -1)  # of pairs of bytes; STOP is in none
        for token, rank in self.ranks.items():
            if len(token) == 2 and STOP not in token:
                self.first[token[0] << 8 | token[1]] = rank
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens."""
        if _known(text):
            return self.split(text)
        if self.split_any is None:
            self.split_any = full(self.pattern)
        return self.split_any(text)

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """The ranks of each pre-token's tokens; none of the pre-tokens is a token itself, nor empty.

        All stand in one linked list, with a stop before, between and behind them: no pair reaches across a stop, so their merges
        don't mix, and that of the least rank anywhere is the next one of its pre-token.
        """
        ranks, queue, longest = self.ranks, self.queue, self.longest
        data = STOP + STOP.join(pieces) + STOP
        byte = np.frombuffer(data, np.uint8).astype(np.int64)
        start = self.first[byte[:-1] << 8 | byte[1:]]
        order = np.argsort(start, kind="stable")
        order = order[np.searchsorted(start[order], 0) :]
        bounds = np.flatnonzero(np.diff(start[order], prepend=-1))
        for places in np.split(order, bounds[1:]) if len(order) else ():
            queue.put(int(start[places[0]]), places.tolist())
        pair = [*start.tolist(), -1]  # the rank of the token that begins here with the next one
        after, ahead = list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))  # places of the next token and of the one before
        for stop in np.flatnonzero(byte == STOP[0]).tolist():
            after[stop] = 0
        buckets = queue.buckets
        while queue.top:
            rank, places = queue.take()
            for i, at in enumerate(places):
                if pair[at] != rank:
                    continue  # stale
                gone = after[at]
                end = after[at] = after[gone]
                ahead[end] = at
                pair[gone] = -1
                stop, begin = after[end], ahead[at]
                pair[at] = follow = ranks.get(data[at:stop], -1) if 0 < stop - at <= longest else -1
                if follow >= 0:
                    bucket = buckets[follow]
                    if bucket is None:
                        queue.put(follow, [at])
                    else:
                        bucket.append(at)
                if after[begin]:
                    pair[begin] = lead = ranks.get(data[begin:end], -1) if end - begin <= longest else -1
                    if lead >= 0:
                        bucket = buckets[lead]
                        if bucket is None:
                            queue.put(lead, [begin])
                        else:
                            bucket.append(begin)
                        if lead < rank:
                            follow = lead
                if 0 <= follow < rank:  # that one is first; the rest wait in their bucket
                    if rest := places[i + 1 :]:
                        if buckets[rank] is None:
                            queue.put(rank, rest)
                        else:
                            buckets[rank].extend(rest)
                    break
        out, at = [], 1
        for piece in pieces:
            ids, end = [], at + len(piece)
            while at < end:
                ids.append(ranks[data[at : after[at]]])
                at = after[at]
            out.append(ids)
            at = end + 1
        return out

    def codes(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of pre-tokens: those seen before from the tables, the others merged at once."""
        young, old = self.young, self.old
        out = {p: code for p in pieces if (code := young.get(p) or old.get(p)) is not None}
        new = pieces - out.keys()
        if new:
            texts = {p: p.encode() for p in new}
            whole = {p: [self.ranks[t]] for p, t in texts.items() if t in self.ranks}
            rest = [p for p in new if p not in whole]
            for p, ids in [*whole.items(), *zip(rest, self.merged([texts[p] for p in rest]), strict=True)]:
                out[p] = struct.pack(f"<{len(ids)}I", *ids)
        if len(young) >= SEEN:
            self.old, self.young = young, {}
        self.young.update((p, code) for p, code in out.items() if len(p) <= SEEN_CHARS)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Pre-tokens are looked up and merged for about UNIT characters at once."""
        out: list[list[bytes]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0

        def unit() -> None:
            codes = self.codes(set().union(*(pieces for _, pieces in held)))
            for row, pieces in held:
                out[row].append(b"".join([codes[p] for p in pieces]))

        for row, text in enumerate(texts):
            for part in parts(text):
                held.append((row, self.pieces(part)))
                size += len(part)
                if size >= UNIT:
                    unit()
                    held, size = [], 0
        unit()
        return [b"".join(codes) for codes in out]

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each row of ids stands for."""
        return [b"".join(map(self.tokens.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids]


_files: dict[tuple[str, str], Ranks] = {}


def ranks_of(path: str, pattern: str) -> Ranks:
    """One for each file, pattern and process."""
    if (path, pattern) not in _files:
        _files[path, pattern] = Ranks(path, pattern)
    return _files[path, pattern]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _mapped(df: DataFrame, column: str, names: list[str], path: str | None, pattern: str | None, act: Callable[[Ranks, list], list[list[bytes]]]) -> DataFrame:
    """df's other columns with those of names, which act makes of a batch of column."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    path = path or default_path()
    rest = [f for f in df.schema if f.name != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = ranks_of(path, pattern)
        for batch in batches:
            others, values = batch.select([f.name for f in rest]), batch.column(column)
            start, held, size = 0, [], 0
            for i, value in enumerate(values):
                held.append(value.as_py())
                size += len(held[-1])
                if size >= RUN_BYTES or i + 1 == len(values):
                    made = [pa.array(x, pa.binary()) for x in act(of, held)]
                    yield pa.RecordBatch.from_arrays([*others.slice(start, len(held)).columns, *made], [*(f.name for f in rest), *names])
                    start, held, size = i + 1, [], 0

    schema = df.select(*[f.name for f in rest]).schema
    for name in names:
        schema = schema.add(name, "binary")
    return df.mapInArrow(run, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("t"))


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """A row per document: doc_id, ids (binary, see above)."""
    return _mapped(_texts(docs), "t", ["ids"], path, pattern, lambda of, texts: [of.encode(texts)])


def decoded(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """rows (doc_id, ids) with ids turned into the bytes they stand for, as column bytes; the ids stay."""
    rows = rows.select("doc_id", "ids", F.coalesce("ids", F.lit(b"")).alias("t"))
    return _mapped(rows, "t", ["bytes"], path, pattern, lambda of, ids: [of.decode(ids)])


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``decoded`` of ``encoded``, by one worker a task."""

    def act(of: Ranks, texts: list[str]) -> list[list[bytes]]:
        ids = of.encode(texts)
        return [ids, of.decode(ids)]

    return _mapped(_texts(docs), "t", ["ids", "bytes"], path, pattern, act)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(documents(spark, sf_dir))
    count = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return rows.select("doc_id", count, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
