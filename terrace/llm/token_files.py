"""Token-ID output, compressed by Re-Pair grammars.

Texts become token ids with an end id each.  In ascending order of document id they are cut
into shards of a bounded number of ids.  In every shard frequent pairs of neighbours are
replaced by new symbols, again and again; a shard stores the rules, the length each symbol
expands to, and the remaining sequence, so that any document is decoded alone.

Shards are rows of a Parquet table in any store Spark writes to, with the file format below
in a binary column.  A task holds one shard and one batch of texts at a time.

Defined results: a null or empty text has the end id alone; a null document id sorts first;
repeated rows are each written; an empty table gives no shard; other columns are dropped.

Format of a shard, little-endian: magic ``RPG1``; uint32 counts of documents, rules and
symbols; uint32 base, the first id that names a rule; uint32 ids per document; per rule two
uint32, its pair; per rule uint32, the number of ids it expands to; uint32 symbols.
"""

from __future__ import annotations

import os
import re
import string
import struct
import threading
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.llm.tables import ship_library, text_or_empty

MAGIC = b"RPG1"
HEAD = struct.Struct("<4s4I")
#: Ids in a shard before it is closed, and documents.
SHARD_IDS, SHARD_DOCS = 1 << 19, 1 << 16
#: Counters for pairs, and how often a pair must occur to be replaced.
COUNTER_BITS, LEAST = 18, 64
COUNTERS = 1 << COUNTER_BITS
#: A space or a line feed before white space or the end, where a text is not cut.
NO_CUT = re.compile(r" (?:\s|\Z)")
NO_LINE_CUT = re.compile(r"\n(?:\s|\Z)")
# The pattern by which byte-level tokenizers split texts before merging, for the
# characters of PLAIN: letters up to U+024F, digits, visible ASCII and line feeds.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile(f"[!-~\n{LETTER}]+")
LETTERS = re.compile(f"[{LETTER}]+")
MARKS = string.punctuation
SPLIT = re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{LETTER}]+| ?[0-9]+| ?[^\\s0-9{LETTER}]+|\n+(?!\\S)|\n+")
#: Bytes of word pieces a worker remembers for good, and then for a while; a piece takes ENTRY besides its own.
REMEMBERED, RECENT, ENTRY = 64 << 20, 8 << 20, 150
#: Characters of the longest piece that is remembered, and texts whose ids are put together at a time.
LONGEST, JOINED = 64, 64
#: Bytes of texts that are encoded at a time, as a part of the bytes remembered.
AT_A_TIME = 8
END_ID = 0


class Encoder(dict[str, bytes]):
    """Ids of whole texts by the tokenizers library, remembering the ids of word pieces.

    The tokenizer splits texts before it merges bytes, and always before a space that a
    character other than white space follows; a byte-level one does so before such a line feed too.
    A text cut there has the ids of its pieces in order.  The distinct pieces of many texts are
    looked up, those not seen before go to the library.  It merges the parts of plain pieces one by one, which saves
    tracking offsets into the text; a part that several pieces share is merged once.  The
    dictionary holds the ids of pieces, each with its space unless it begins with a line feed; a
    piece it misses is encoded.  It takes what comes first, which frequent pieces do, up to
    ``REMEMBERED`` bytes; later ones are remembered until they fill ``RECENT`` bytes.  Of a rare
    word with marks behind it only the word is remembered, and of other rare pieces the parts.

    Texts that hold an added token are encoded whole by the library, as it splits them there.
    With ``escape_special``, the names of special tokens are text like any other.
    """

    def __init__(self, path: str, escape_special: bool = True, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = escape_special
        added = self.tokenizer.get_added_tokens_decoder().values()
        split = [t for t in added if not (escape_special and t.special)]
        self.added = [t.content for t in split]
        # What a normalizer makes of a text may hold a token that the text does not.
        self.always_whole = self.tokenizer.normalizer is not None and any(t.normalized for t in split)
        self.model = self.tokenizer.model
        #: Ids of the parts of pieces that follow no space.
        self.inner: dict[str, bytes] = {}
        #: Pieces that came when there was no room any more.
        self.recent: dict[str, bytes] = {}
        self.room, self.room_for_recent = REMEMBERED if remembered is None else remembered, RECENT
        splits = self.tokenizer.pre_tokenizer
        self.in_parts = isinstance(splits, ByteLevel) and splits.use_regex and not self.tokenizer.normalizer
        self.by_line = self.in_parts and not splits.add_prefix_space
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        plain = filter(PLAIN.match, map(chr, range(0x250)))
        self.space = level.pre_tokenize_str(" ")[0][0]
        self.symbols = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in [" ", *plain]})

    @staticmethod
    def pieces(text: str) -> list[str]:
        """Cut at single spaces; all but the first piece have lost theirs."""
        cut = text.split(" ")
        whole = [cut[0]]
        for p in cut[1:]:
            if not p or p[0].isspace():
                whole[-1] += " " + p
            else:
                whole.append(p)
        return whole

    def _whole(self, text: str) -> bool:
        return self.always_whole or any(token in text for token in self.added)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _merged(self, symbols: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        ids = self.recent.get(piece)
        if ids is not None:
            return ids
        if not self.in_parts:
            return self._remember(piece, self._library([" " + piece])[0])
        if piece[:1] == "\n":
            return self._of_a_line(piece)
        word = piece.rstrip(MARKS)
        if not word.isalpha() or not (word.isascii() or LETTERS.fullmatch(word)):
            return self._of_parts(piece)
        if word == piece:
            return self._remember(piece, self._merged(self.space + (word if word.isascii() else self._symbols(word))))
        known = self.get(word)
        ids = (self[word] if known is None else known) + self._part(piece[len(word) :])
        return ids if known is None or self.room <= 0 else self._remember(piece, ids)

    def _remember(self, piece: str, ids: bytes) -> bytes:
        if len(piece) <= LONGEST:
            if self.room > 0:
                self[piece] = ids
                self.room -= ENTRY + len(piece) + len(ids)
            else:
                self._hold_a_while(piece, ids)
        return ids

    def _hold_a_while(self, piece: str, ids: bytes) -> None:
        self.recent[piece] = ids
        self.room_for_recent -= ENTRY + len(piece) + len(ids)
        if self.room_for_recent <= 0:
            self.recent, self.room_for_recent = {}, RECENT

    def _symbols(self, part: str) -> str:
        return part.translate(self.symbols)

    def _part(self, part: str) -> bytes:
        """Ids of a part that follows no space."""
        ids = self.inner.get(part)
        if ids is None:
            ids = self._merged(self._symbols(part))
            if len(part) <= LONGEST and self.room > 0:
                self.inner[part] = ids
                self.room -= ENTRY + len(part) + len(ids)
        return ids

    def _of_a_line(self, piece: str) -> bytes:
        rest = piece[1:]
        if not PLAIN.fullmatch(rest):
            return self._remember(piece, self._library([piece])[0])
        parts = SPLIT.findall(rest)
        known = len(parts) <= 2 and parts[0] in self.inner
        ids = self._part("\n") + b"".join(map(self._part, parts))
        return self._remember(piece, ids) if known and self.room > 0 else ids

    def _of_parts(self, piece: str) -> bytes:
        if not PLAIN.fullmatch(piece):
            return self._remember(piece, self._library([" " + piece])[0])
        first, *rest = SPLIT.findall(" " + piece)
        if not rest:
            return self._remember(piece, self._merged(self._symbols(first)))
        return self[first[1:]] + b"".join(map(self._part, rest))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32.  Every piece is looked up once for all of them."""
        firsts, plain, rests, other, others, lengths = [], [], [], [], [], []
        for i, text in enumerate(texts):
            if self._whole(text):
                first, space = text, ""
            elif NO_CUT.search(text):
                first, *cut = self.pieces(text)
                other.append(i)
                others += cut
                lengths.append(len(cut))
                space = ""
            else:
                if self.by_line and "\n" in text and not NO_LINE_CUT.search(text):
                    text = text.replace("\n", " \n")
                first, space, rest = text.partition(" ")
            firsts.append(first)
            if space:
                plain.append(i)
                rests.append(rest)
        cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        pieces = pa.concat_arrays([cut.flatten(), pa.array(others, pa.large_string())]).dictionary_encode()
        found = list(map(self.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False)))
        ends = np.concatenate([cut.offsets.to_numpy(), len(cut.flatten()) + np.cumsum(lengths, dtype=np.int64)])
        encoded = self._library(firsts)
        for i, ids in zip(plain + other, _joined(found, pieces.indices.to_numpy(), ends), strict=True):
            encoded[i] += ids
        return encoded


def _joined(found: list[bytes], which: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
    """Per text the ids of its pieces; a text's pieces end where the next one's begin."""
    widths = np.fromiter(map(len, found), np.int64, len(found)) // 4
    starts = np.cumsum(widths) - widths
    flat = np.frombuffer(b"".join(found), "<u4")
    for i in range(0, len(ends) - 1, JOINED):
        bounds = ends[i : i + JOINED + 1]
        these = which[bounds[0] : bounds[-1]]
        width = widths[these]
        after = np.cumsum(width)
        place = np.repeat(starts[these] - after + width, width)
        place += np.arange(len(place))
        ids = flat[place].tobytes()
        at = (4 * np.concatenate([[0], after])[bounds - bounds[0]]).tolist()
        for a, b in zip(at[:-1], at[1:], strict=True):
            yield ids[a:b]


@lru_cache(maxsize=1)
def encoder(path: str, escape_special: bool, remembered: int) -> Encoder:
    return Encoder(path, escape_special, remembered)


#: Seconds after its last task that a worker keeps its encoder for the next one.
IDLE = 2.0
_forgetting: list[threading.Timer] = []


def forget() -> None:
    """Give back the encoder's memory and what Arrow holds of batches that are gone."""
    encoder.cache_clear()
    pa.default_memory_pool().release_unused()


def keep_a_while() -> None:
    """Give the encoder's memory back unless another task asks for it soon."""
    timer = threading.Timer(IDLE, forget)
    timer.daemon = True
    timer.start()
    _forgetting.append(timer)


def keep() -> None:
    while _forgetting:
        _forgetting.pop().cancel()


def _counter(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Counters of pairs, from 32-bit symbols."""
    mixed = left.astype(np.uint32) * np.uint32(0x9E3779B1)
    mixed += right.astype(np.uint32) * np.uint32(0x85EBCA6B)
    return (mixed >> np.uint32(32 - COUNTER_BITS)).astype(np.int32)


def repair(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (left, right), the length each expands to, and the remaining sequence.

    Rounds go on until no pair of neighbours occurs ``LEAST`` times.  A round counts the pairs,
    replaces frequent ones, the overlapping ones every second time, and leaves the rest to the
    next round.  Counters are shared by the pairs that hash to them; only pairs under full
    counters are then counted one by one, and the most frequent one of each counter is replaced.
    Counts of old pairs only fall, so after the first round only those places are looked at
    where a pair was frequent or has become a new one.
    """
    seq, rules = ids.astype(np.int32), [np.empty((0, 2), np.int64)]
    lengths = np.ones(0, np.int64)
    places = np.arange(len(seq) - 1, dtype=np.int32)
    while len(places):
        every = len(places) == len(seq) - 1
        left, right = (seq[:-1], seq[1:]) if every else (seq[places], seq[places + 1])
        slots = _counter(left, right)
        full = np.flatnonzero((np.bincount(slots, minlength=COUNTERS) >= LEAST)[slots])
        places, slots, found = places[full], slots[full], left[full].astype(np.int64) << 32 | right[full]
        pairs, counts = np.unique(found, return_counts=True)
        pairs = pairs[counts >= LEAST][np.argsort(counts[counts >= LEAST], kind="stable")]
        if not len(pairs):
            break
        # The most frequent pair of each counter is replaced in this round, the others have theirs to come.
        of = _counter(pairs >> 32, pairs & 0xFFFFFFFF)
        leader = np.full(COUNTERS, -1)
        leader[of] = np.arange(len(pairs))
        again = np.zeros(COUNTERS, bool)
        again[of[leader[of] != np.arange(len(pairs))]] = True
        which = leader[slots]
        led = (which >= 0) & (pairs[which] == found)
        places, at, which = places[again[slots]], places[led], which[led]
        run = np.ones(len(at), bool)
        run[1:] = at[1:] != at[:-1] + 1
        first = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        every_second = (np.arange(len(at)) - first) % 2 == 0
        at, which = at[every_second], which[every_second]
        used = np.flatnonzero(np.bincount(which, minlength=len(pairs)))
        numbers = np.zeros(len(pairs), np.int32)
        numbers[used] = np.arange(len(used), dtype=np.int32)
        which = numbers[which]
        new = np.stack([pairs[used] >> 32, pairs[used] & 0xFFFFFFFF], axis=1)
        seq[at] = base + len(lengths) + which
        size = np.where(new >= base, lengths[np.maximum(new - base, 0)] if len(lengths) else 1, 1).sum(axis=1)
        rules.append(new)
        lengths = np.concatenate([lengths, size])
        # The places that are left, and both sides of each new symbol, in the shorter sequence.
        look = np.zeros(len(seq), bool)
        look[places], look[at], look[np.maximum(at - 1, 0)] = True, True, True
        rest = np.ones(len(seq), bool)
        rest[at + 1] = False
        seq, look = seq[rest], look[rest]
        places = np.flatnonzero(look[:-1])
    return np.concatenate(rules).astype(np.uint32), lengths.astype(np.uint32), seq.astype(np.uint32)


def write_shard(counts: list[int], ids: np.ndarray, base: int) -> bytes:
    rules, lengths, seq = repair(ids, base)
    head = HEAD.pack(MAGIC, len(counts), len(rules), len(seq), base)
    parts = (np.array(counts, "<u4"), rules.astype("<u4"), lengths.astype("<u4"), seq.astype("<u4"))
    return head + b"".join(p.tobytes() for p in parts)


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, data: bytes):
        magic, docs, rules, symbols, self.base = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        flat, at = np.frombuffer(data, "<u4", offset=HEAD.size), 0
        self.counts, at = flat[:docs].astype(np.int64), docs
        self.rules, at = flat[at : at + 2 * rules].reshape(-1, 2).astype(np.int64), at + 2 * rules
        self.lengths, at = flat[at : at + rules].astype(np.int64), at + rules
        self.seq = flat[at : at + symbols].astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        # All symbols in one table: an id stands for itself, a rule for the ids it expands to.
        self.widths = np.concatenate([np.ones(self.base, np.int64), self.lengths.astype(np.int64)])
        self._at = np.cumsum(self.widths) - self.widths
        self._ids = np.concatenate([np.arange(self.base), self._rule_ids()]).astype("<u4")
        self._ends = np.cumsum(self.widths[self.seq])

    def _rule_ids(self) -> np.ndarray:
        """The ids of all rules: symbols are replaced by their pairs until no rule is left."""
        symbols = self.base + np.arange(len(self.rules))
        while len(named := np.flatnonzero(symbols >= self.base)):
            width = np.ones(len(symbols), np.int64)
            width[named] = 2
            starts = np.cumsum(width) - width
            grown = np.empty(int(width.sum()), np.int64)
            grown[starts] = symbols
            pairs = self.rules[symbols[named] - self.base]
            grown[starts[named]], grown[starts[named] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = grown
        return symbols

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that a sequence of symbols stands for."""
        width = self.widths[symbols]
        place = np.repeat(self._at[symbols] - np.cumsum(width) + width, width)
        place += np.arange(len(place))
        return self._ids[place]

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i`` alone: only the symbols that reach into it are expanded."""
        start, end = int(self.starts[i]), int(self.starts[i + 1])
        first, last = np.searchsorted(self._ends, [start, end - 1], side="right")
        before = int(self._ends[first - 1]) if first else 0
        return self.expand(self.seq[first : last + 1])[start - before : end - before]

    def documents(self) -> Iterator[np.ndarray]:
        ids = self.expand(self.seq)
        for a, b in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
            yield ids[a:b]


SHARD = "part int, shard int, before long, n_ids long, doc_ids array<long>, data binary"


def encode_shards(
    docs: DataFrame,
    path: str,
    vocabulary: int | None = None,
    end_id: int = END_ID,
    escape_special: bool = True,
    remembered: int = REMEMBERED,
    give_back: bool = False,
) -> DataFrame:
    """One row per shard: its place, the ids before it in its part, its documents, its file.

    Parts are ranges of document ids; rows that share an id are ordered by a hash of the text,
    and equal ones by where they were read, so that no part has to take them all.  A worker
    remembers ``remembered`` bytes of word pieces for good and encodes an eighth of that in texts at a
    time; with less it encodes more pieces anew.  With ``give_back`` it returns what Arrow has
    gathered whenever a shard is closed, which takes some 4 % more time.
    """
    ship_library(docs.sparkSession)
    text = text_or_empty("text").alias("text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("tie")]
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, F.monotonically_increasing_id().alias("tie"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep()
        encode = encoder(path, escape_special, remembered)
        base = vocabulary or encode.tokenizer.get_vocab_size()
        tail = struct.pack("<I", end_id)
        names, counts, data, held = [], [], [], 0
        part, shard, before = 0, 0, 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(data), "<u4")
            row = [part, shard, before, len(ids), list(names), write_shard(counts, ids, base)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            if give_back:
                pa.default_memory_pool().release_unused()
            columns = [pa.array([v], t) for v, t in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, ["part", "shard", "before", "n_ids", "doc_ids", "data"])

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            keys, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            group = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // max(1, remembered // AT_A_TIME)
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(keys)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for key, ids in zip(keys[a:b], encode.encode(texts.slice(a, b - a).to_pylist()), strict=True):
                    names.append(key)
                    data.append(ids + tail)
                    counts.append(len(data[-1]) // 4)
                    held += counts[-1]
                    if held >= SHARD_IDS or len(names) >= SHARD_DOCS:
                        yield close()
                        shard, before = shard + 1, before + held
                        names, counts, data, held = [], [], [], 0
        if names:
            yield close()
        keep_a_while()

    return ordered.mapInArrow(pack, SHARD)


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    escape_special: bool = True,
    remembered: int = REMEMBERED,
    give_back: bool = False,
) -> None:
    shards = encode_shards(docs, tokenizer, escape_special=escape_special, remembered=remembered, give_back=give_back)
    shards.write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, part, shard`` per document, decoded from the files.

    ``start`` counts the ids of all documents before.  Only one number per part meets in a window.
    """
    shards = spark.read.schema(SHARD).parquet(path)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()  # reading has no use for the words that writing left in this worker
        for batch in batches:
            for row in batch.itertuples(index=False):
                shard = Shard(row.data)
                yield pd.DataFrame(
                    {
                        "part": row.part,
                        "shard": row.shard,
                        "doc_id": pd.array(list(row.doc_ids), dtype="Int64"),
                        "at": row.before + shard.starts[:-1],
                        "n_tokens": shard.counts,
                        "ids_crc32": [zlib.crc32(d) for d in shard.documents()],
                    }
                )

    rows = shards.mapInPandas(unpack, "part int, shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        F.col("part").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
    return rows.join(parts, F.col("part") == F.col("of")).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "shard"
    )
