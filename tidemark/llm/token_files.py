"""Token ids as binary files: Arrow record batches of fixed-size lists, for training jobs that map files into memory.

Documents are ordered by identifier over the whole table, encoded whole, closed with an end id, and packed without
gaps into sequences of equal length. A file holds batches with two columns, fixed-size lists of ids and of a mask
(0 where the last sequence of a file is padded); any sequence is a view of the mapped file, without a copy. A second
file beside it lists the documents: identifier, first position in the file, number of ids.

Files are written by the tasks to the shared folder under names of their own (see files.attempt_name); the manifest,
a row per file, is what the driver gets.

Defined results: a null text counts as empty and gives the end id alone. Null identifiers come first; rows of equal
identifiers are ordered by text. Other columns are ignored. An empty table gives no files and an empty index.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import chunks
from tidemark.llm.files import attempt_name, resolve
from tidemark.llm.words import PLAIN, PLAIN_TAIL, Memo, hold, release, runs, words_of

#: Sequences of one record batch.
BATCH_ROWS = 64
#: Bytes of text encoded at a time.
CHUNK_BYTES = 4_000_000
#: New words that the tokenizer gets as one text, and what its tokens for the end of a word end in.
JOINED_WORDS = 1000
#: Characters of a text by which rows of one identifier are ranged.
RANGE_CHARS = 32
WORD_END = "</w>"

_MANIFEST = "part long, tokens_path string, docs_path string, n_docs long, n_tokens long"
_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class WordEncoder:
    """The tokenizer of a file, with the ids of words remembered.

    Only for tokenizers that drop white space and case and part letters from signs: a text's ids are then those of its
    words one after the other, and those of "Word," are those of "word" and of ",".
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype(np.uint16 if size <= 65536 else np.uint32)
        self.closes = np.zeros(size, bool)  # ids that close a word
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.closes[i] = token.endswith(WORD_END)
        self.stems = Memo(self._make, self.dtype)

    def _make(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found: list[np.ndarray] = []
        sizes = np.zeros(len(stems), np.int64)
        owner: list[np.ndarray] = []
        plain = [i for i, w in enumerate(stems) if w.isalpha()]
        other = [i for i, w in enumerate(stems) if not w.isalpha()]
        # words of letters alone go through the tokenizer as one text, in which each has one id that closes it
        for k in range(0, len(plain), JOINED_WORDS):
            part = plain[k : k + JOINED_WORDS]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([stems[i] for i in part])], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part):  # a letter whose lower case is more than letters
                other += part
                continue
            found.append(ids)
            owner.append(np.repeat(part, np.diff(ends, prepend=0)))
        for i, e in zip(other, self.tokenizer.encode_batch_fast([stems[i] for i in other], add_special_tokens=False), strict=True):
            found.append(np.array(e.ids, self.dtype))
            owner.append(np.full(len(e.ids), i))
        flat, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, owner))
        sizes += np.bincount(at, minlength=len(stems))
        return flat[np.argsort(at, kind="stable")], sizes

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (and the last one's end)."""
        codes, starts, words = words_of(texts)
        one, two = (pc.match_substring_regex(words, p).to_numpy(zero_copy_only=False) for p in (PLAIN, PLAIN_TAIL))
        rest = ~one & ~two
        plain, tails = words.filter(pa.array(one)), words.filter(pa.array(two))
        # a word is one stem or, with a sign behind letters, two
        stems = pa.concat_arrays([pc.utf8_lower(plain), pc.utf8_lower(pc.utf8_rtrim(tails, characters=".,")), pc.utf8_slice_codeunits(tails, -1), words.filter(pa.array(rest))])
        counts = np.where(two, 2, 1)
        begin = np.cumsum(counts) - counts
        order = np.empty(len(stems), np.int64)
        named = stems.dictionary_encode()
        order[np.concatenate([begin[one], begin[two], begin[two] + 1, begin[rest]])] = named.indices.to_numpy(zero_copy_only=False)
        first, size = self.stems.find(named.dictionary)
        flat = self.stems.flat[runs(first[order], size[order])]
        ends = np.concatenate([[0], np.cumsum(size[order])])
        first, size = ends[begin], ends[begin + counts] - ends[begin]
        ends = np.concatenate([[0], np.cumsum(size[codes])])
        return flat[runs(first[codes], size[codes])], ends[starts]


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer's file."""
    return hold(path, lambda: WordEncoder(path))


class SequenceWriter:
    """Packs ids into equal-length sequences and writes them as record batches."""

    def __init__(self, sink, length: int, dtype: np.dtype):
        self.length, self.dtype = length, np.dtype(dtype)
        kind = pa.list_(pa.from_numpy_dtype(self.dtype), length)
        self.schema = pa.schema([("ids", kind), ("mask", pa.list_(pa.bool_(), length))])
        self.out = pa.ipc.new_file(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.count = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.count += len(ids)
        self.total += len(ids)
        most = self.length * BATCH_ROWS
        if self.count >= most:
            flat = np.concatenate(self.held)
            whole = self.count // most * most
            for k in range(0, whole, most):
                self._batch(flat[k : k + most], most)
            self.held, self.count = [flat[whole:]], self.count - whole

    def _batch(self, ids: np.ndarray, size: int) -> None:
        padded, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
        padded[: len(ids)], mask[: len(ids)] = ids, True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.out.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.count:
            self._batch(np.concatenate(self.held), -(-self.count // self.length) * self.length)
        self.out.close()


class SequenceFile:
    """Random access to the sequences of a file; on a mapped local file every result is a view of the map."""

    def __init__(self, uri: str):
        system, path = resolve(uri)
        self.source = pa.memory_map(path) if system.type_name == "local" else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size

    def batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of a batch as sequences x length, and its masks (bits, so as an Arrow array)."""
        found = self.reader.get_batch(k)
        return found["ids"].flatten().to_numpy().reshape(-1, self.length), found["mask"]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        ids, mask = self.batch(i // BATCH_ROWS)
        return ids[i % BATCH_ROWS], mask[i % BATCH_ROWS].values

    def slices(self, starts: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of consecutive documents, a batch in memory at a time."""
        held, first, k = np.zeros(0, np.int64), 0, 0
        for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
            parts = [held[start - first :]]
            have = len(parts[0])
            while have < size:
                first = k * BATCH_ROWS * self.length
                held = self.batch(k)[0].reshape(-1)
                k += 1
                parts.append(held)
                have += len(held)
            yield np.concatenate(parts)[:size] if len(parts) > 1 else parts[0][:size]

    def close(self) -> None:
        self.source.close()


@dataclass(frozen=True)
class TokenFile:
    """A row of the manifest; base is the number of ids in all files before it."""

    tokens_path: str
    docs_path: str
    n_docs: int
    n_tokens: int
    base: int


def write_token_files(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int, length: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> list[TokenFile]:
    """Encodes docs into files below `folder`, in ascending order of identifiers over all files."""

    def write(batches):
        coder, writer, index = word_encoder(tokenizer_file), None, None
        system, _ = resolve(folder)
        part, n_docs = TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in chunks(batch, most=CHUNK_BYTES):
                if writer is None:
                    tokens = attempt_name(folder, f"tokens-{part:06d}", ".arrow")
                    system.create_dir(resolve(folder)[1], recursive=True)
                    sinks = [system.open_output_stream(resolve(p)[1]) for p in (tokens, tokens + ".docs")]
                    writer = SequenceWriter(sinks[0], length, coder.dtype)
                    index = pa.ipc.new_file(sinks[1], _DOCS)
                ids, ends = coder.encode(rows["text"])
                sizes = np.diff(ends) + 1
                starts = writer.total + np.cumsum(sizes) - sizes
                writer.add(np.insert(ids, ends[1:], end_id))
                index.write_batch(pa.record_batch([rows["doc_id"], pa.array(starts), pa.array(sizes)], schema=_DOCS))
                n_docs += len(sizes)
            release()
        if writer is not None:
            writer.close()
            index.close()
            for s in sinks:
                s.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "tokens_path": [tokens], "docs_path": [tokens + ".docs"], "n_docs": [n_docs], "n_tokens": [writer.total]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the start of the text, so that an identifier (or null) that many rows share doesn't fill one file
    ordered = rows.repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    found, base = [], 0
    for r in sorted(ordered.mapInArrow(write, _MANIFEST).collect(), key=lambda r: r["part"]):  # a row per file
        found.append(TokenFile(r["tokens_path"], r["docs_path"], r["n_docs"], r["n_tokens"], base))
        base += r["n_tokens"]
    return found


def read_token_files(spark: SparkSession, files: list[TokenFile]) -> DataFrame:
    """A row per document, read back: doc_id, start over all files, n_tokens, ids_crc32 of the ids as 32-bit little-endian."""

    def read(batches):
        for batch in batches:
            for file in batch.to_pylist():
                system, path = resolve(file["docs_path"])
                ids = SequenceFile(file["tokens_path"])
                with system.open_input_file(path) as source:
                    index = pa.ipc.open_file(source)
                    parts = [index.get_batch(k) for k in range(index.num_record_batches)]
                starts, sizes = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("start", "n_tokens"))
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids.slices(starts, sizes)]
                ids.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([p["doc_id"] for p in parts]), pa.array(starts + file["base"]), pa.array(sizes), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = [(f.tokens_path, f.docs_path, f.base) for f in files]
    listed = spark.createDataFrame(rows, "tokens_path string, docs_path string, base long")
    return listed.repartition(max(1, len(files))).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
