"""Token ids in a compact binary format: frequency-ranked ids, byte-aligned lengths, separate control bytes.

Every text is encoded by a public tokenizer. Ids are replaced by their frequency rank over the whole
corpus, so common ids take one byte; each rank takes one to four bytes, and its two-bit length goes to a
separate control stream, which numpy decodes by table lookup. Documents are dealt to shards by ranges of
their key, sorted, and packed into blocks; a shard is written by one task and its blocks are in key order.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import bytes_of, discard, pieces, read_table, scratch_folder, stored
from eventmart.llm.words import mixed, same_strings, string_hash

#: Block layout, little-endian: magic, documents, ids, ids of the shard before this block; then keys
#: (int64), null marks (uint8), ids per document (uint32), control bytes and data bytes.
HEADER = "<8sIQQ"
MAGIC = b"TOKBLK01"
#: Units of texts that a Python worker remembers between pieces, about 60 bytes each.
REMEMBERED = 1_000_000
#: Punctuation at the end of a part, a word of its own under the tokenizer's rule.
TAIL = ".,;:!?*$%&#|)"
#: Bytes of control and data after which a block is closed.
BLOCK_BYTES = 1 << 20

#: Slots of remembered units to begin with.
LEAST_SLOTS = 1 << 16

#: First byte of U+00C0 to U+00FF in UTF-8.
LATIN = 0xC3
#: In place of the length of a unit whose key is exact.
EXACT = -1

#: The four lengths of each control byte, as one number.
_LENGTHS = np.array([[(c >> (2 * k) & 3) + 1 for k in range(4)] for c in range(256)], np.uint8).view("<u4")[:, 0]
_encoders: dict[str, "Encoder"] = {}

#: Masks of the first 0 to 8 bytes of a number.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)
_FIRST_4 = _FIRST[:5].astype(np.uint32)

# The rules of a tokenizer whose texts may be encoded in units.
EXPECTED_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}

#: Kinds of bytes: separators of parts, letters, digits, punctuation, and what makes a part one unit (beyond ASCII but for letters after LATIN,
#: control bytes, the apostrophe of contractions, and the bracket that special tokens begin with).
BLANK, LETTER, DIGIT, MARK, ODD = range(5)
_KIND = bytes([BLANK if b in b" \n\t" else ODD if b < 33 or b > 126 or b in b"'<" else LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK for b in range(256)])
#: The byte alphabet of byte-level tokenizers: printable bytes of Latin-1 stand for themselves, the others for the characters from U+0100 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_ALPHABET = "".join(chr(b) if b in _PRINTED else chr(256 + _OTHERS.index(b)) for b in range(256))
_LOWER = bytes([b + 32 if 65 <= b <= 90 else b for b in range(256)])


def encode_ranks(ranks: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit values, and data bytes of each document.

    n: values of each document. A control byte holds four two-bit lengths, and each document begins a new one.
    """
    size = (ranks > 0xFF).astype(np.uint8)
    for limit in (0xFFFF, 0xFFFFFF):
        size += ranks > limit
    used = _used(n)
    codes = np.zeros(len(used), np.uint8)
    codes[used] = size
    quads = codes.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    size += 1
    ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    at = ends[:-1]
    data = np.empty(int(ends[-1]), np.uint8)
    data[at] = ranks.astype(np.uint8)
    for k in range(1, int(size.max(initial=1))):
        on = np.flatnonzero(size > k)
        data[at[on] + k] = (ranks[on] >> np.uint32(8 * k)).astype(np.uint8)
    return control, data, np.diff(ends[np.concatenate([[0], np.cumsum(n)])])


def _used(n: np.ndarray) -> np.ndarray:
    """Which places have a value when every document begins at a multiple of four."""
    width = -(-n // 4) * 4
    ends, out = np.cumsum(width), np.ones(int(width.sum()), bool)
    for k in range(1, 4):
        out[ends[width - n >= k] - k] = False
    return out


def decode_ranks(control: np.ndarray, data: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The values that encode_ranks wrote."""
    size = _LENGTHS[control].view(np.uint8)[_used(n)]
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.concatenate([data, np.zeros(4, np.uint8)])
    numbers = np.ndarray((len(data) + 1,), "<u4", padded, 0, (1,))  # the number that begins at each byte
    return numbers[at] & _FIRST_4[size]


class Encoder:
    """Ids of whole text columns under one tokenizer, with what a worker remembers of it.

    Under EXPECTED_RULES white space is dropped and no token spans it, so a text's ids are those of its parts between
    blanks. A part of plain characters (printable ASCII and the letters U+00C0 to U+00FF, which compose with none of them) is further
    cut where the tokenizer cuts it: runs of letters, single digits and runs
    of punctuation. Units are remembered by a 64-bit key in a table of open addresses. The key of a
    plain unit of up to 8 bytes is the unit; for others it is a hash, and what is taken from memory has been compared by its
    bytes. A unit whose key another one has is encoded each time that it comes. Under any other rules whole texts are encoded one by one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        rules = {name: json.loads(part.__getstate__()) if (part := getattr(self.tokenizer, name)) is not None else None for name in EXPECTED_RULES}
        self.in_units = rules == EXPECTED_RULES and all(t.content[:1] == "<" and " " not in t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        # entry 0 is no unit; entries: first id, number of ids, first byte, number of bytes (EXACT where the key is exact)
        self.keys, self.entries, self.ids, self.spelled = np.zeros(1, np.uint64), np.zeros((1, 4), np.int32), np.zeros(1, self.kind), np.zeros(0, np.uint8)
        self.rooms = {}
        self.slots = np.zeros(LEAST_SLOTS, np.int32)

    def append(self, name: str, more: np.ndarray) -> None:
        """Adds to an array of the memory, which is the used part of a larger one: what is there is seldom copied."""
        have = getattr(self, name)
        used, need = len(have), len(have) + len(more)
        if need > len(self.rooms.get(name, ())):
            self.rooms[name] = np.empty((need + need // 2, *have.shape[1:]), have.dtype)
            self.rooms[name][:used] = have
        self.rooms[name][used:need] = more
        setattr(self, name, self.rooms[name][:need])

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a column without nulls, each text closed by end_id, and the number of ids of each text."""
        if not self.in_units:
            whole = [np.array([*e.ids, end_id], self.kind) for e in self.tokenizer.encode_batch(column.to_pylist(), add_special_tokens=False)]
            return np.concatenate(whole), np.array([len(x) for x in whole])
        data, offsets = bytes_of(column)
        text, starts, ends, odd = units(data, offsets)
        key, short = unit_keys(data, text, starts, ends, odd)
        at = self.find(key)
        new = np.flatnonzero(at == 0)
        if len(new):
            _, one = np.unique(key[new], return_index=True)
            one = new[one]
            self.remember(key[one], _spellings(text, starts[one], ends[one]), odd[one], short[one])
            at[new] = self.find(key[new])
        found = self.entries.take(at, 0)
        # a short unit is its key; others are compared with what is remembered
        right = found[:, 3] == np.where(short, EXACT, ends - starts)
        long = np.flatnonzero(right & ~short)
        right[long] = same_strings(text, starts[long], self.spelled, found[long, 2].astype(np.int64), found[long, 3].astype(np.int64))
        other = np.flatnonzero(~right)
        row_end = np.searchsorted(starts, offsets[1:])  # after its last unit each text has its end id
        first, size, known = found[:, 0], found[:, 1], self.ids
        if len(other):  # their hashes are those of other units
            lists = self.ids_of(_spellings(text, starts[other], ends[other]), odd[other])
            size[other] = [len(x) for x in lists]
            first[other] = len(known) + np.cumsum(size[other]) - size[other]
            known = np.append(known, np.fromiter(chain.from_iterable(lists), self.kind))
        first, size = np.insert(first, row_end, 0), np.insert(size, row_end, 1)
        stop = np.cumsum(size, dtype=np.int64)
        flat = np.repeat(first - (stop - size), size)
        flat += np.arange(len(flat))
        ids = known.take(flat)
        last = stop[row_end + np.arange(len(row_end))]
        ids[last - 1] = end_id
        return ids, np.diff(last, prepend=0)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The entry of each key, 0 where it has none."""
        mask = len(self.slots) - 1
        slot = (key >> np.uint64(20)).astype(np.int64) & mask
        at = self.slots[slot]
        open_ = np.flatnonzero((at != 0) & (self.keys[at] != key))
        while len(open_):  # another key has the slot: the next one
            slot[open_] = (slot[open_] + 1) & mask
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] != 0) & (self.keys[at[open_]] != key[open_])]
        return at

    def place(self, entries: np.ndarray) -> None:
        """Puts entries, which have no slot yet, to the first free slot from that of their key; at most half of the slots are taken."""
        if 2 * len(self.keys) > len(self.slots):
            self.slots = np.zeros(max(2 * len(self.slots), 1 << (4 * len(self.keys) - 1).bit_length()), np.int32)
            entries = np.arange(1, len(self.keys))
        mask = len(self.slots) - 1
        slot = (self.keys[entries] >> np.uint64(20)).astype(np.int64) & mask
        while len(entries):
            free = np.flatnonzero(self.slots[slot] == 0)
            self.slots[slot[free]] = entries[free]  # of those that want one slot, one has it
            left = np.flatnonzero(self.slots[slot] != entries)
            entries, slot = entries[left], (slot[left] + 1) & mask

    def ids_of(self, spelled: list[bytes], odd: np.ndarray) -> list[list[int]]:
        """Ids of units; odd: which are parts with more than plain characters in them."""
        flags = odd.tolist()
        words = iter(self.of_words([u for u, o in zip(spelled, flags, strict=True) if not o]))
        parts = iter(self.of_parts([u.decode() for u, o in zip(spelled, flags, strict=True) if o]))
        return [next(parts if o else words) for o in flags]

    def remember(self, keys: np.ndarray, spelled: list[bytes], odd: np.ndarray, short: np.ndarray) -> None:
        """Adds units: their keys, each once, their bytes, whether they are parts with more than plain characters in them, and whether their keys are exact."""
        lists = self.ids_of(spelled, odd)
        size, length = np.fromiter(map(len, lists), np.int64, len(lists)), np.fromiter(map(len, spelled), np.int64, len(spelled))
        new = np.arange(len(self.keys), len(self.keys) + len(keys))
        self.append("entries", np.stack([np.cumsum(size) - size + len(self.ids), size, np.cumsum(length) - length + len(self.spelled), np.where(short, EXACT, length)], 1))
        self.append("ids", np.fromiter(chain.from_iterable(lists), self.kind, int(size.sum())))
        self.append("spelled", np.frombuffer(b"".join(spelled), np.uint8))
        self.append("keys", keys)
        self.place(new)

    def of_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of words that the tokenizer's rules keep whole: they go to its model directly, in its byte alphabet."""
        tokenize = self.tokenizer.model.tokenize
        return [[t.id for t in tokenize(w.decode() if w.isascii() else charmap_decode(w, "strict", _ALPHABET)[0])] for w in words]

    def of_parts(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts with more than plain characters; those of letters and then punctuation are two words of the rules."""
        split, out = {}, {}
        for part in parts:
            core = part.rstrip(TAIL)
            word = core.lower()
            # the lower case of a capital sigma depends on its place, so words with one take the other way
            if core.isalpha() and word.isalpha() and "\u03a3" not in core and is_normalized("NFC", core) and is_normalized("NFC", word):
                split[part] = (word, part[len(core) :])
        words = sorted({x for pair in split.values() for x in pair if x})
        known = dict(zip(words, self.of_words([w.encode() for w in words]), strict=True)) | {"": []}
        out = {part: known[word] + known[tail] for part, (word, tail) in split.items()}
        other = [p for p in parts if p not in out]
        out |= {p: e.ids for p, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False), strict=True)}
        return [out[p] for p in parts]


def _spellings(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = text.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts, lower-cased outside odd units, starts and ends of their units, and which of these are odd: whole
    parts with more than plain characters in them."""
    kind, text = (np.frombuffer(bytearray(data).translate(table), np.uint8) for table in (_KIND, _LOWER))
    lead = np.flatnonzero(data == LATIN)
    second = data[lead + 1]
    letter = (second != 0x97) & (second != 0xB7)  # but for the signs of multiplication and division
    kind[lead[letter]] = kind[lead[letter] + 1] = LETTER
    text[lead[letter & (second < 0x9F)] + 1] += 32
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    blank = kind == BLANK
    cut = ~blank
    cut[1:] &= blank[:-1] | edge[1:-1]  # where parts begin
    strange = np.flatnonzero(kind == ODD)
    if len(strange):
        part = np.searchsorted(np.flatnonzero(cut), strange, "right") - 1
        part = part[np.diff(part, prepend=-1) > 0]
        starts, ends = (x[part] for x in _spans(cut, blank))
        size = ends - starts
        inside = np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)
        kind[inside], text[inside] = ODD, data[inside]
    cut[1:] |= ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & ~blank[1:]
    starts, ends = _spans(cut, blank)
    return text, starts, ends, kind[starts] == ODD


def _spans(cut: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches that begin at cuts and end before a cut or a blank."""
    stop = ~blank
    stop[:-1] &= blank[1:] | cut[1:]
    return np.flatnonzero(cut), np.flatnonzero(stop) + 1


def unit_keys(data: np.ndarray, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each unit, and which are exact: those of plain characters of up to 8 bytes, none of them zero, are their bytes, mixed
    by a bijection. The others are hashes, which may be the key of another unit."""
    size = ends - starts
    short = ~odd & (size <= 8)
    padded = np.concatenate([lower, np.zeros(8, np.uint8)])
    words = np.ndarray((len(lower) + 1,), "<u8", padded, 0, (1,))  # the number that begins at each byte
    key = mixed(words[starts].astype(np.uint64) & _FIRST[np.minimum(size, 8)])
    for source, these, turn in ((lower, ~short & ~odd, False), (data, odd, True)):
        on = np.flatnonzero(these)
        found = string_hash(source, starts[on], ends[on])
        key[on] = ~found if turn else found
    return key, short


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    encoder = _encoders[path]
    if len(encoder.keys) > REMEMBERED or len(encoder.ids) > 4 * REMEMBERED or len(encoder.spelled) > 16 * REMEMBERED:
        encoder.forget()
    return encoder


def token_table(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2) -> DataFrame:
    """key and ids (little-endian 16- or 32-bit, end id included) of each row, stored once."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, n = _encoder(tokenizer).encode(batch.column("text"), end_id)
            width = ids.dtype.itemsize
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([width] * len(n), pa.int32()), _binaries(ids.view(np.uint8), n * width)], ["key", "width", "ids"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return stored(rows.mapInArrow(encode, "key long, width int, ids binary"), "tokens", compression="zstd")


def id_ranks(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """rank[id] by descending corpus frequency, then id. At most `vocabulary` counts leave each task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in pieces(batches, "ids"):
            ids, width = bytes_of(batch.column("ids"))[0], batch.column("width")[0].as_py()  # one tokenizer, so one width
            total += np.bincount(ids.view(f"<u{width}"), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])

    counts = tokens.select("width", "ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(vocabulary, np.int64)
    total[counts["id"].to_numpy()] = counts["n"].to_numpy()
    ranks = np.empty(vocabulary, np.uint32)
    ranks[np.lexsort((np.arange(vocabulary), -total))] = np.arange(vocabulary, dtype=np.uint32)
    return ranks


def write_blocks(tokens: DataFrame, ranks: np.ndarray, shards: int, folder: str) -> None:
    """Writes the rank table (rank, id) to folder/ranks and the blocks to folder/blocks: shard, block, n_tokens and the block's image, each shard in key order."""
    bounds = tokens.agg(F.percentile_approx("key", [(k + 1) / shards for k in range(shards - 1)], 10_000).alias("b")).first()["b"] if shards > 1 else []
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "ids"):
            keys = batch.column("key")
            shard = np.searchsorted(bounds, keys.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)).astype(np.int32)
            raw, ends = bytes_of(batch.column("ids"))
            width = batch.column("width")[0].as_py()  # one tokenizer, so one width
            n = np.diff(ends) // width
            control, data, sizes = encode_ranks(ranks[raw.view(f"<u{width}")], n)
            yield pa.RecordBatch.from_arrays([pa.array(shard), keys, pa.array(n), _binaries(control, -(-n // 4)), _binaries(data, sizes)], ["shard", "key", "n", "control", "data"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, base, rows, held = None, 0, 0, [], 0

        def image():
            n = np.array([r[1] for r in rows], np.uint32)
            keys = np.array([r[0] or 0 for r in rows], np.int64)
            null = np.array([r[0] is None for r in rows], np.uint8)
            head = struct.pack(HEADER, MAGIC, len(rows), int(n.sum()), base)
            body = b"".join([head, keys.tobytes(), null.tobytes(), n.tobytes(), *(r[2] for r in rows), *(r[3] for r in rows)])
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([int(n.sum())], pa.int64()), pa.array([body], pa.binary())], ["shard", "block", "n_tokens", "image"])

        for batch in batches:
            for s, key, n, control, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (s != shard or held > BLOCK_BYTES):
                    yield image()
                    block, base, rows, held = block + 1, base + sum(r[1] for r in rows), [], 0
                if s != shard:
                    shard, block, base = s, 0, 0
                rows.append((key, n, control, data))
                held += len(control) + len(data)
        if rows:
            yield image()

    dealt = tokens.mapInArrow(ranked, "shard int, key long, n long, control binary, data binary").repartitionById(shards, "shard")
    dealt.sortWithinPartitions("shard", "key").mapInArrow(pack, "shard int, block int, n_tokens long, image binary").write.option("compression", "none").parquet(f"{folder}/blocks")
    # one row for each id of the tokenizer
    table = pa.table({"rank": pa.array(ranks.astype(np.int64)), "id": pa.array(np.arange(len(ranks)))})
    tokens.sparkSession.createDataFrame(table).coalesce(1).write.parquet(f"{folder}/ranks")


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """A binary column of consecutive stretches of data."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def read_blocks(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Documents of a folder that write_blocks filled: key, start, n_tokens, ids_crc32 and, if asked for, the ids."""
    files = spark.read.parquet(f"{folder}/blocks")
    table = spark.read.parquet(f"{folder}/ranks").toPandas()  # one row for each id of the tokenizer
    ids_of = np.empty(len(table), np.uint32)
    ids_of[table["rank"].to_numpy()] = table["id"].to_numpy()
    # one row for each shard: the number of shards is a parameter of the writer
    totals = {r["shard"]: r["n"] for r in files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    before, seen = {}, 0
    for shard in sorted(totals):
        before[shard] = seen
        seen += totals[shard]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, image in zip(batch.column("shard").to_pylist(), batch.column("image"), strict=True):
                yield documents(shard, memoryview(image.as_buffer()))

    def documents(shard: int, image: memoryview) -> pa.RecordBatch:
        magic, rows, _, base = struct.unpack_from(HEADER, image)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = struct.calcsize(HEADER)
        keys = np.frombuffer(image, "<i8", rows, at)
        null = np.frombuffer(image, np.uint8, rows, at := at + 8 * rows).astype(bool)
        n = np.frombuffer(image, "<u4", rows, at := at + rows).astype(np.int64)
        at += 4 * rows
        controls = int((-(-n // 4)).sum())
        ids = ids_of[decode_ranks(np.frombuffer(image, np.uint8, controls, at), np.frombuffer(image, np.uint8, -1, at + controls), n)].astype("<u4")
        cuts = np.concatenate([[0], np.cumsum(n)])
        raw = memoryview(ids.tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        start = before[shard] + base + np.cumsum(n) - n
        out = [pa.array(keys, mask=null), pa.array(start), pa.array(n), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(out + [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int64)))] * with_ids, ["key", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    schema = "key long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return files.select("shard", "image").mapInArrow(decode, schema).withColumnRenamed("key", key)


def token_output(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, shards: int | None = None, folder: str | None = None) -> DataFrame:
    """One row per row of docs, read back from the written blocks: key, start, n_tokens, ids_crc32.

    folder: where the corpus stays (see write_blocks and read_blocks), by default a new one in the shared folder.

    Null text counts as empty and has the end id alone. Rows follow ascending key, null keys first; rows
    that share a key are neighbours in an order that is not defined. An empty table gives an empty result.
    Other columns are not read.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    vocabulary = max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1)
    tokens = token_table(docs, tokenizer, key, text, end_id)
    ranks = id_ranks(tokens, vocabulary)
    folder = folder or f"{scratch_folder(spark)}/token-corpus-{uuid.uuid4().hex}"
    write_blocks(tokens, ranks, shards or int(spark.conf.get("spark.sql.shuffle.partitions")), folder)
    discard(spark, tokens)
    return read_blocks(spark, folder, key)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_output(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
