"""Token ids as Arrow stream files of fixed-size-list batches.

Documents are encoded, closed by an end id, put in order of their ids and laid end to end. The stream of
ids is cut into sequences of equal length, and a file holds them as an Arrow stream: a schema message, then
batches of equally many sequences with three fixed-size lists for each:

    ids     the token ids, in two bytes where the vocabulary allows it and in four otherwise
    mask    true for an id, false for the padding at the end of the file
    starts  true for the first id of a document

As no list has a length of its own, all batches but the last have one size in bytes: batch ``k`` lies ``k`` sizes
after the first, and ``TokenFile`` reads any sequence from a memory map without copying or scanning. A file holds
whole documents; its schema's metadata names them and the file's place among the others.

Files are written by Spark's own text writer, a file a row, so they go to any file system that Spark knows and only
committed tasks leave any. The writer's line feed comes after the stream's end mark, where readers stop.

Texts are encoded by the ``tokenizers`` library. Where a vocabulary drops white space, what lies between is
encoded once and remembered, up to a bound, by each Python worker.

Defined results: a null or empty text is its end id alone. Null ids come first; rows of equal id follow each other in
order of a hash of their text, and repeated rows keep places of their own. An empty table gives no file and an empty
result. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from quillprep.llm.columns import running_total, text_or_empty
from quillprep.llm.ordering import in_pieces, numbered
from quillprep.session import scratch_path

_TEXT_AT_ONCE = 1 << 22
# Printable ASCII and the Latin letters up to U+017E that are composed already and have one lower-case letter.
_PLAIN = "^[!-~À-ÖØ-öø-įĲ-ňŊ-ž]+$"
# The only pattern of words that is followed here; Arrow's expressions and the library's cut plain strings alike by it.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@dataclass(frozen=True)
class FileParams:
    """``sequence`` ids a sequence, ``batch`` sequences a batch, about ``file_ids`` ids a file, of whole documents.

    A task makes the files of about ``range_bytes`` of text. A worker remembers at most ``remembered`` pieces of text, or
    those of some megabytes of it where they are more.
    """

    sequence: int = 2048
    batch: int = 64
    file_ids: int = 1 << 22
    end_id: int = 1
    range_bytes: int = 1 << 24
    remembered: int = 1 << 19

    def __post_init__(self) -> None:
        if min(self.sequence, self.batch, self.file_ids, self.range_bytes, self.remembered) < 1 or self.end_id < 0:
            raise ValueError("sizes must be positive, end_id must not be negative")


class _Ranges:
    """Ids of distinct strings, in one array with a range for each; emptied when it is full. The empty string has none."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.slot = {"": 0}
        self.flat = np.zeros(1 << 12, np.uint32)
        self.edges = np.zeros(1 << 10, np.int64)

    def add(self, strings: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        """Strings with their ids, one after another, and where each one's end there."""
        at, begin = len(self.slot), self.edges[len(self.slot)]
        self.flat = _grown(self.flat, int(begin) + len(ids))
        self.edges = _grown(self.edges, at + len(strings) + 1)
        self.flat[begin : begin + len(ids)] = ids
        self.edges[at + 1 : at + 1 + len(strings)] = begin + ends
        self.slot.update(zip(strings, range(at, at + len(strings)), strict=True))

    def slots(self, strings: list[str], learn: Callable[[list[str]], None]) -> np.ndarray:
        """The slots of these distinct strings; ``learn`` adds those that are not held."""
        if len(self.slot) + len(strings) > self.limit:
            self.clear()
        if fresh := [s for s in strings if s not in self.slot]:
            learn(fresh)
        return np.fromiter(map(self.slot.__getitem__, strings), np.int64, len(strings))

    def ids(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the strings in these slots, one after another, and how many each has."""
        return _picked(self.flat, self.edges, slots)


def _picked(flat: np.ndarray, edges: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``flat`` between these edges and the next, one after another, and how long each is."""
    begin, length = edges[slots], edges[slots + 1] - edges[slots]
    ends = np.cumsum(length)
    at = np.repeat(begin - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)
    return flat[at], length


def _sums(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _offsets(lists: pa.ListArray) -> np.ndarray:
    """Where each list begins among the flattened values, and where the last one ends."""
    return lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Encoder:
    """Ids of texts as the library gives them, with strings that return encoded once.

    A vocabulary whose splitting removes all white space and whose words end in a mark of their own gives a text
    the ids of what lies between white space, one after another. Of those, strings of printable ASCII and of letters that
    normalization leaves alone are lower-cased and cut by the file's own pattern, each distinct one of a batch once and all
    of them by Arrow; each piece goes to its model once. Whatever else there is passes through the whole of it.
    """

    def __init__(self, path: str, remembered: int) -> None:
        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size(with_added_tokens=True)
        self.others, self.pieces = _Ranges(remembered), _Ranges(remembered)
        plan = json.loads(self.whole.to_str())
        self.pattern = self._pattern(plan)
        if self.pattern is not None:
            self.special = "|".join(re.escape(t["content"]) for t in plan["added_tokens"])
            end = plan["model"]["end_of_word_suffix"]
            ends = np.zeros(self.size, bool)
            ends[[number for token, number in plan["model"]["vocab"].items() if token.endswith(end)]] = True
            self.ends = ends
            # the file's model behind a split at spaces; bytes of visible ASCII stand for themselves in its vocabulary
            spaces, octets = {"type": "WhitespaceSplit"}, plan["pre_tokenizer"]["pretokenizers"][1]
            bare = lambda cut: Tokenizer.from_str(json.dumps(plan | {"normalizer": None, "pre_tokenizer": cut, "added_tokens": []}))
            self.ascii_model = bare(spaces)
            self.model = bare({"type": "Sequence", "pretokenizers": [spaces, octets]})

    @staticmethod
    def _pattern(plan: dict) -> str | None:
        """The pattern of words, if the file's steps are those that this class can follow; else texts are encoded whole."""
        steps = [s["type"] for s in (plan["normalizer"] or {}).get("normalizers", [])]
        cuts = (plan["pre_tokenizer"] or {}).get("pretokenizers", [])
        follows = (
            steps == ["NFC", "Replace", "Lowercase"]
            and plan["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _WORDS}
            and cuts[0]["behavior"] == "Removed"
            and cuts[0]["invert"]
            and not cuts[1]["add_prefix_space"]
            and not cuts[1]["use_regex"]
            and plan["post_processor"] is None
            and plan["model"].get("end_of_word_suffix")
            and not any(t["lstrip"] or t["rstrip"] or t["normalized"] for t in plan["added_tokens"])
        )
        return _WORDS if follows else None

    def _learn_pieces(self, fresh: list[str]) -> None:
        for model, own in ((self.ascii_model, [p for p in fresh if p.isascii()]), (self.model, [p for p in fresh if not p.isascii()])):
            for at in range(0, len(own), 4096):
                part = own[at : at + 4096]
                ids = np.array(model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
                # each piece ends in an end-of-word token, and has no other
                self.pieces.add(part, ids, np.flatnonzero(self.ends[ids]) + 1)

    def _learn_others(self, fresh: list[str]) -> None:
        lists = [e.ids for e in self.whole.encode_batch_fast(fresh, add_special_tokens=False)]
        self.others.add(fresh, np.fromiter(chain.from_iterable(lists), np.uint32), np.cumsum([len(ids) for ids in lists]))

    def _plain_ids(self, plain: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain strings, one after another, and how many each has."""
        lower = pc.utf8_lower(plain).dictionary_encode()
        # each piece is closed by a space, so an empty one follows the last
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(lower.dictionary, self.pattern, r"\0 "))
        found = lists.flatten().dictionary_encode()
        slots = self.pieces.slots(_strings(found.dictionary), self._learn_pieces)
        ids, lengths = self.pieces.ids(slots[found.indices.to_numpy()])
        return _picked(ids, _sums(lengths)[_offsets(lists)], lower.indices.to_numpy())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has; null as empty."""
        texts = pc.fill_null(texts, "")
        if self.pattern is None:
            lists = [e.ids for e in self.whole.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in lists for i in ids], np.uint32), np.array([len(ids) for ids in lists], np.int64)
        lists = pc.ascii_split_whitespace(texts)
        known = lists.flatten().dictionary_encode()
        distinct = known.dictionary
        plain = pc.match_substring_regex(distinct, _PLAIN)
        if self.special:
            plain = pc.and_not(plain, pc.match_substring_regex(distinct, self.special))
        plain_ids, plain_lengths = self._plain_ids(distinct.filter(plain))
        other_ids, other_lengths = self.others.ids(self.others.slots(_strings(distinct.filter(pc.invert(plain))), self._learn_others))
        # plain strings first, then the others, and where each distinct one has gone
        is_plain = plain.to_numpy(zero_copy_only=False)
        place = np.where(is_plain, np.cumsum(is_plain) - 1, len(plain_lengths) + np.cumsum(~is_plain) - 1)
        edges = _sums(np.concatenate([plain_lengths, other_lengths]))
        ids, lengths = _picked(np.concatenate([plain_ids, other_ids]), edges, place[known.indices.to_numpy()])
        return ids, np.diff(_sums(lengths)[_offsets(lists)])


# One for each vocabulary file and bound, kept by a Python worker from task to task.
_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int) -> Encoder:
    key = (path, remembered)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, remembered)
    return _ENCODERS[key]


def _stretches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows ``[a, b)`` of about ``_TEXT_AT_ONCE`` characters; a longer row alone."""
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > _TEXT_AT_ONCE:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def id_type(vocabulary_size: int, params: FileParams) -> np.dtype:
    """Little-endian ids of two bytes where all fit, else of four."""
    return np.dtype("<u2" if max(vocabulary_size - 1, params.end_id) < 1 << 16 else "<u4")


def file_bytes(ids: np.ndarray, lengths: list[int], doc_ids: list, place: tuple[int, int], params: FileParams) -> bytes:
    """An Arrow stream of one file's documents: ``lengths`` of them in ``ids``, one after another."""
    width = params.sequence
    count = -(-len(ids) // width)
    flat, mask, starts = np.zeros(count * width, ids.dtype), np.zeros(count * width, bool), np.zeros(count * width, bool)
    flat[: len(ids)] = ids
    mask[: len(ids)] = True
    starts[np.cumsum([0, *lengths[:-1]])] = True
    about = {"part": place[0], "nth": place[1], "sequences": count, "batch": params.batch, "ids": len(ids), "doc_ids": doc_ids}
    lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), width) for values in (flat, mask, starts)]
    names = ("ids", "mask", "starts")
    fields = [pa.field(n, pa.list_(pa.field("item", a.type.value_type, False), width), False) for n, a in zip(names, lists, strict=True)]
    schema = pa.schema(fields, {"tokens": json.dumps(about)})
    lists = [pa.FixedSizeListArray.from_arrays(a.values, type=f.type) for a, f in zip(lists, fields, strict=True)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        whole = pa.RecordBatch.from_arrays(lists, schema=schema)
        for at in range(0, count, params.batch):
            out.write_batch(_compact(whole.slice(at, params.batch)))
    return sink.getvalue().to_pybytes()


def _compact(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A slice with buffers of its own, so that equally long ones are written alike."""
    return pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in batch.columns], schema=batch.schema)


class TokenFile:
    """Random access to the sequences of a file, over a memory map or bytes, without copying them."""

    def __init__(self, source: str | bytes | pa.Buffer) -> None:
        self.buffer = pa.memory_map(source).read_buffer() if isinstance(source, str) else pa.py_buffer(source)
        reader = pa.BufferReader(self.buffer)
        self.schema = pa.ipc.read_schema(reader)
        self.about = json.loads(self.schema.metadata[b"tokens"])
        self.first = reader.tell()
        pa.ipc.read_message(reader)
        self.size = reader.tell() - self.first

    def __len__(self) -> int:
        return self.about["sequences"]

    def batch(self, k: int) -> pa.RecordBatch:
        """Batch ``k``, from its place in the file alone."""
        message = pa.ipc.read_message(pa.BufferReader(self.buffer.slice(self.first + k * self.size)))
        return pa.ipc.read_record_batch(message, self.schema)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """``(ids, mask, starts)`` of sequence ``i``; ids are a view into the file."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        batch, at = self.batch(i // self.about["batch"]), i % self.about["batch"]
        ids, mask, starts = (column[at].values for column in batch.columns)
        return ids.to_numpy(), mask, starts

    def documents(self) -> Iterator[tuple[object, int, np.ndarray]]:
        """``(doc_id, place of its first id in the file, ids)`` of each document, in order."""
        batches = [self.batch(k) for k in range(-(-len(self) // self.about["batch"]))]
        column = lambda n: np.concatenate([b.column(n).flatten().to_numpy(zero_copy_only=False) for b in batches])
        ids = column("ids")[column("mask")]
        edges = [*np.flatnonzero(column("starts")).tolist(), len(ids)]
        for doc_id, a, b in zip(self.about["doc_ids"], edges[:-1], edges[1:], strict=True):
            yield doc_id, a, ids[a:b]


def write_files(docs: DataFrame, vocabulary: str, path: str, params: FileParams = FileParams(), id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write them as token files under ``path``, in order of their ids, nulls first.

    Texts are shuffled once, by ranges of their ids, and encoded where their file is made.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"), F.monotonically_increasing_id().alias("row_no")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    ranges = in_pieces(rows, [F.col("doc_id").asc_nulls_first(), F.col("tie")], -(-size // params.range_bytes), "part")

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary, params.remembered)
        width = id_type(known.size, params)
        held, count, part, nth = [], 0, 0, 0

        def close() -> pa.RecordBatch:
            ids, lengths, doc_ids = zip(*held, strict=True)
            made = file_bytes(np.concatenate(ids), [n for l in lengths for n in l], [d for l in doc_ids for d in l], (part, nth), params)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["file"])

        for b in batches:
            for start, end in _stretches(pc.binary_length(b.column("text")).to_numpy(zero_copy_only=False)):
                rows = b.slice(start, end - start)
                part, doc_ids = rows.column("part")[0].as_py(), rows.column("doc_id").to_pylist()
                ids, lengths = known.encode(rows.column("text"))
                closed = np.insert(ids, np.cumsum(lengths), params.end_id).astype(width)
                edges = np.concatenate([[0], np.cumsum(lengths + 1)])
                at = 0
                while at < len(doc_ids):
                    # the documents up to the one that fills the file
                    upto = min(int(np.searchsorted(edges, edges[at] + params.file_ids - count)), len(doc_ids))
                    held.append((closed[edges[at] : edges[upto]], np.diff(edges[at : upto + 1]).tolist(), doc_ids[at:upto]))
                    count, at = count + int(edges[upto] - edges[at]), upto
                    if count >= params.file_ids:
                        yield close()
                        held, count, nth = [], 0, nth + 1
        if held:
            yield close()

    made = ranges.select("part", "doc_id", "text").mapInArrow(files, "file binary")
    made.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_documents(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32, part, nth`` of each document in the files under ``path``.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is over its ids in four little-endian bytes each.
    """
    content = spark.read.format("binaryFile").load(path).filter("length > 1").select("content")

    ddl = f"doc_id {id_type}, at long, n_tokens long, ids_crc32 long, part long, nth long"
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for value in b.column("content"):
                file = TokenFile(value.as_buffer())
                found = [(d, at, len(ids), crc32(ids.astype("<u4").tobytes())) for d, at, ids in file.documents()]
                doc_ids, at, n, crc = (list(c) for c in zip(*found, strict=True))
                about = {k: [file.about[k]] * len(found) for k in ("part", "nth")}
                yield pa.RecordBatch.from_pydict({"doc_id": doc_ids, "at": at, "n_tokens": n, "ids_crc32": crc} | about, schema=out)

    found = numbered(content.mapInArrow(parse, ddl)).drop("row_no")
    sizes = found.groupBy("part", "nth").agg(F.sum("n_tokens").alias("size"))
    bases = running_total(sizes, [], F.expr("part div 1024"), [F.col("part"), F.col("nth")], F.col("size"), "base").drop("size")
    return found.join(bases, ["part", "nth"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "part", "nth")
