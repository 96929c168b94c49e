"""Token ids in ORC: encode, write in id order, read back by stripes.

File format under one folder:

``data/``
    ORC files in ascending ``doc_id`` order: file k holds smaller ids than file k+1 and
    rows are sorted inside a file.  Columns ``doc_id``, ``n_tokens``, ``file_offset``
    (ids of the documents before it in the same file) and ``tokens`` (array<int>).  ORC
    stores the ids with its integer run-length encoding, keeps minimum and maximum of
    ``doc_id`` per stripe and per row group (row index) and a Bloom filter on it.
``manifest/``
    One row per data file: name, first and last id, rows, tokens, and ``base``, the
    number of ids in all files before it.  ``base + file_offset`` is a document's
    position in the whole stream, so nothing has to be scanned to seek.

Readers take stripes in parallel (Spark splits ORC files at stripes); a filter on
``doc_id`` is pushed to the reader, which skips files, stripes and row groups by their
minimum and maximum and by the Bloom filter.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .common import BATCH_ROWS, prepare, trim_memory

STRIPE_BYTES = 16 << 20
ROW_INDEX_STRIDE = 1000
#: Words remembered by one worker, and their characters.
MEMO_PIECES = 400_000
MEMO_CHARS = 8 << 20

DATA_SCHEMA = "doc_id bigint, n_tokens bigint, file_offset bigint, tokens array<int>"

_GAP = re.compile(r"(?<=\S) (?=\S)")
# White space other than the space and the line feed.
_OTHER = re.compile(r"[^\S \n]")
_SPACES = re.compile(r"\s")
_OTHER_ASCII = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
# A word, and words parted by single line feeds, with or without a space before them.
_PLAIN = re.compile(r" ?\S+")
_LINES = re.compile(r" ?\S+(?:\n\S+)*")
#: Marks that are no part of the word before them.
_MARKS = ".,;:!?"
#: The usual way of cutting texts into words, by which the finer cuts hold.
_USUAL = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
#: Characters per call of the library.
CALL_CHARS = 2000


class PieceEncoder:
    """Encodes whole texts with the tokenizers library, each distinct word once.

    A byte-level BPE first cuts a text into words; a single space between two
    non-space characters always begins a new word, so a text may be cut there and the
    ids of the pieces joined: the result equals encoding the whole text.  Where the
    library cuts by the usual rule of byte-level vocabularies, pieces are cut further, so
    that fewer differ: a single line feed between other characters and the marks that
    follow a letter or digit at the end of a line are words of their own.

    Natural text repeats its words, so most come from a (bounded) memo; Arrow splits the
    texts and numbers the pieces, Python sees each distinct piece of a batch once.

    New words go to the library in runs that are texts themselves: " a b c" or, of words
    without a space, "a\nb\nc".  The ids whose token starts with a space, or those of the
    line feed, part the run again.
    """

    def __init__(self, path: str, memo_pieces: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo_pieces = memo_pieces
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        space, feed = "\u0120", "\u010a"  # how byte-level vocabularies write the bytes 0x20 and 0x0A
        self.opens[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        self.feed = vocabulary.get(feed, -1)
        self.cuts = self.tokenizer.normalizer is None and str(self.tokenizer.pre_tokenizer) == _USUAL
        self.clear()

    def clear(self) -> None:
        #: Number of each word by its text, the space before it included.
        self.memo: dict[str, int] = {}
        self.chars = 0
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.lens = np.empty(0, np.int64)
        #: Batches in which each word was met.
        self.met = np.empty(0, np.int32)

    def most_pieces(self) -> int:
        return MEMO_PIECES if self.memo_pieces is None else self.memo_pieces

    def _forget(self) -> None:
        """Keep the words met more than once, or none where they are too many."""
        kept = np.flatnonzero(self.met > 1)
        words = list(itertools.compress(self.memo, (self.met > 1).tolist()))
        flat, lens, chars = _gathered(self.flat, self.starts[kept], self.lens[kept]), self.lens[kept], sum(map(len, words))
        self.clear()
        if len(words) <= self.most_pieces() // 2 and chars <= MEMO_CHARS // 2:
            self._keep(words, flat, lens)

    def _call(self, strings: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.asarray(e.ids, np.int32) for e in got]

    def _keep(self, fresh: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        self.memo.update(zip(fresh, range(len(self.memo), len(self.memo) + len(fresh)), strict=True))
        self.chars += sum(map(len, fresh))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lens) - lens])
        self.flat = np.concatenate([self.flat, flat])
        self.lens = np.concatenate([self.lens, lens])
        self.met = np.concatenate([self.met, np.zeros(len(lens), np.int32)])

    def _learn_alone(self, fresh: list[str]) -> None:
        """Encode words one by one."""
        if fresh:
            ids = self._call(fresh)
            self._keep(fresh, np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn_runs(self, fresh: list[str], feed: str) -> None:
        """Encode words, many in a call: those after a space as they are, others after a feed."""
        if not fresh:
            return
        run = max(1, CALL_CHARS * len(fresh) // (sum(map(len, fresh)) + len(fresh)))
        got = self._call([feed + feed.join(fresh[k:k + run]) for k in range(0, len(fresh), run)])
        flat = np.concatenate(got)
        first = np.flatnonzero(flat == self.feed if feed else self.opens[flat])
        if len(first) != len(fresh):  # a tokenizer of another make
            self._learn_alone(fresh)
            return
        lens = np.diff(first, append=len(flat))
        if feed:
            flat, lens = np.delete(flat, first), lens - 1
        self._keep(fresh, flat, lens)

    def _learn(self, words: Iterable[str], inside: bool) -> None:
        """``inside``: words may hold white space but for the space at their beginning."""
        fresh = set(words).difference(self.memo)
        alone = {w for w in fresh if not _PLAIN.fullmatch(w)} if inside else fresh & {"\n"}
        fresh = fresh - alone if alone else fresh
        spaced = [w for w in fresh if w[0] == " "]
        heads = [] if len(spaced) == len(fresh) else [w for w in fresh if w[0] != " "]
        self._learn_runs(spaced, "")
        if self.cuts:
            self._learn_runs(heads, "\n")
            self._learn_alone(list(alone))
        else:
            self._learn_alone([*heads, *alone])

    def _words(self, piece: str) -> list[str]:
        """The words of a piece, which begins with the space before it, if there is one."""
        if not self.cuts or not _LINES.fullmatch(piece):
            return [piece]
        out = []
        for k, line in enumerate(piece.split("\n")):
            base = line.rstrip(_MARKS)
            if not (base and base[-1].isascii() and base[-1].isalnum()):
                base = line
            out += ["\n", base] if k else [base]
            if len(base) < len(line):
                out.append(line[len(base):])
        return out

    def _split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, bool]:
        """(pieces of all texts, none empty; number of pieces of each; has a piece white space
        inside).  A line feed cut off is a piece of its own."""
        odd = [_is_odd(t) for t in texts]
        if self.cuts:
            texts = [t if o else t.replace("\n", " \n ") for t, o in zip(texts, odd, strict=True)]
        if any(odd):
            found = [_GAP.split(t) if o else t.split(" ") for t, o in zip(texts, odd, strict=True)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            return pa.array(list(itertools.chain.from_iterable(found)), pa.large_string()), counts, True
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        return parts.flatten(), np.diff(parts.offsets.to_numpy()), not self.cuts

    def _numbers(self, pieces: pa.Array, inside: bool) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of each piece in a row, number of words of each piece)."""
        sizes = np.ones(len(pieces), np.int64)
        if not self.cuts:
            words = _strings(pieces)
            self._learn(words, inside)
            return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words)), sizes
        bases = pc.ascii_rtrim(pieces, _MARKS)
        marked = pc.and_(pc.match_substring_regex(bases, r"[0-9A-Za-z]\z"), pc.less(
            pc.binary_length(bases), pc.binary_length(pieces)))
        firsts = _strings(pc.if_else(marked, bases, pieces))
        marked = marked.to_numpy(zero_copy_only=False)
        sizes[marked] = 2
        many = {}
        names = _strings(pieces)
        if inside:
            many = {k: self._words(name) for k, name in enumerate(names) if _SPACES.search(name, 1)}
            for k, found in many.items():
                sizes[k], marked[k], firsts[k] = len(found), False, found[0]
        at = np.flatnonzero(marked)
        marks = [names[k][len(firsts[k]):] for k in at.tolist()]
        more = [w for found in many.values() for w in found[1:]]
        self._learn(itertools.chain(firsts, marks, more), inside)
        number = np.empty(int(sizes.sum()), np.int64)
        start = np.cumsum(sizes) - sizes
        number[start] = np.fromiter(map(self.memo.__getitem__, firsts), np.int64, len(firsts))
        number[start[at] + 1] = np.fromiter(map(self.memo.__getitem__, marks), np.int64, len(marks))
        for k, found in many.items():
            number[start[k] + 1:start[k] + len(found)] = [self.memo[w] for w in found[1:]]
        return number, sizes

    def encode(self, texts: Sequence[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by ``end_id``; and the length of each."""
        if len(self.memo) > self.most_pieces() or self.chars > MEMO_CHARS:
            self._forget()
        counts = np.zeros(len(texts), np.int64)
        pieces, counts[[k for k, t in enumerate(texts) if t]], inside = self._split([t for t in texts if t])
        pieces = pieces.dictionary_encode()
        which, names = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary
        ends = np.cumsum(counts)
        # Pieces at the start of a text, line feeds and what stands after them follow no space.
        head = np.zeros(len(which) + 1, bool)
        head[(ends - counts)[counts > 0]] = True
        if self.cuts and (feed := pc.index(names, pa.scalar("\n", names.type)).as_py()) >= 0:
            feeds = np.flatnonzero(which == feed)
            head[feeds] = head[feeds + 1] = True
        head = np.flatnonzero(head[:-1])
        heads, after = np.unique(which[head], return_inverse=True)
        which[head] = len(names) + after
        spaced = pc.binary_join_element_wise(pa.scalar(" ", names.type), names, pa.scalar("", names.type))
        number, sizes = self._numbers(pa.concat_arrays([spaced, names.take(pa.array(heads))]), inside)
        self.met[number] += 1
        # Ids of each distinct piece, then of each piece.
        lens = self.lens[number]
        flat = _gathered(self.flat, self.starts[number], lens)
        at = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(sizes)])]
        lens = np.diff(at)[which]
        total = np.concatenate([[0], np.cumsum(lens)])
        flat = _gathered(flat, at[which], lens)
        return np.insert(flat, total[ends], end_id), total[ends] - total[ends - counts] + 1


#: Encoders of this process, which go on from task to task.
_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, memo_pieces: int | None = None) -> PieceEncoder:
    key = path, memo_pieces
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, memo_pieces)
    return _ENCODERS[key]


def forget_encoders() -> None:
    """Drop this worker's encoders and return their memory: other work follows."""
    _ENCODERS.clear()
    trim_memory()


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _is_odd(text: str) -> bool:
    """Has white space at an end, beside other white space, or other than the space and the line feed."""
    return ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[0] in " \n" or text[-1] in " \n"
            or (any(c in text for c in _OTHER_ASCII) if text.isascii() else _OTHER.search(text) is not None))


def _gathered(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The slices ``flat[s:s + n]`` one after the other."""
    ends = np.cumsum(lens)
    return flat[np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)]


def _list_array(values: np.ndarray, lens: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def write_token_orc(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id",
                    text_col: str = "text", end_id: int = 2, batch_rows: int = BATCH_ROWS,
                    memo_pieces: int | None = None) -> str:
    """Encode ``docs`` and write the format above under ``path``; returns ``path``.

    The raw rows are range-partitioned by id and sorted (one shuffle of ids and texts),
    and only then encoded, inside the writing tasks: the sampling of the ranges never
    runs the tokenizer, and a lost task re-encodes its own range alone.

    Null text: no ids but the end.  Null id: kept, sorted first.  Rows of equal id: all
    kept, ordered by a hash of their text.  Columns other than id and text are not read.
    An empty table leaves no data file and an empty manifest.

    ``batch_rows`` and ``memo_pieces`` (texts encoded, words remembered at a time) trade
    memory of a worker for time; the files are the same.
    """
    spark = docs.sparkSession
    prepare(spark)

    def encode(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        trim_memory()
        coder, offset = encoder(tokenizer_path, memo_pieces), 0
        for b in (whole.slice(at, batch_rows) for whole in it for at in range(0, whole.num_rows, batch_rows)):
            values, lens = coder.encode(b.column(1).to_pylist(), end_id)
            ends = offset + np.cumsum(lens)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens), pa.array(ends - lens), _list_array(values, lens)],
                names=["doc_id", "n_tokens", "file_offset", "tokens"])
            offset = int(ends[-1]) if len(ends) else offset

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"),
                       docs[text_col].cast("string").alias("text"))
    tie = F.xxhash64("text")
    (rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
     .select("doc_id", "text")
     .mapInArrow(encode, DATA_SCHEMA)
     .write.option("orc.compress", "ZSTD")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.row.index.stride", str(ROW_INDEX_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES))
     .orc(f"{path}/data"))
    _write_manifest(spark, path)
    return path


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATA_SCHEMA).orc(f"{path}/data")


def _write_manifest(spark: SparkSession, path: str) -> None:
    """One row per file from the two narrow columns; the running sum is over files only.

    Files follow each other by their part numbers, which ascend with the ranges they were
    written from (as numbers: from the 100,000th file on, names do not sort like them)."""
    files = (_data(spark, path)
             .groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
                  F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")))
    with_bases(files).coalesce(1).write.orc(f"{path}/manifest")


def with_bases(files: DataFrame) -> DataFrame:
    """(file, n_tokens, ...) with ``base``: the ids of all files before it."""
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint")
    before = Window.orderBy(part, "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file string, first_id bigint, last_id bigint, n_docs bigint, "
                             "n_tokens bigint, base bigint").orc(f"{path}/manifest")


def read_token_orc(spark: SparkSession, path: str,
                   doc_ids: Sequence[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, tokens) from the files; ``start`` counts the ids of all
    documents before it.  ``doc_ids`` is pushed to the ORC reader (statistics, Bloom)."""
    data = _data(spark, path)
    if doc_ids is not None:
        data = data.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    data = data.select("*", F.col("_metadata.file_name").alias("file"))
    bases = read_manifest(spark, path).select("file", "base")
    # One short row per file: broadcast below 100,000 files, joined by file above.
    if bases.count() <= 100_000:
        bases = F.broadcast(bases)
    return data.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("file_offset")).alias("start"), "n_tokens", "tokens")


def stream_digest(tokens: DataFrame, forget: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows of ``read_token_orc``: the crc32 runs
    over the ids as little-endian unsigned 32-bit integers, computed per stripe.

    ``forget``: nothing is encoded any more, the workers' encoders are dropped."""
    prepare(tokens.sparkSession)

    def digest(it: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        if forget:
            forget_encoders()
        for b in it:
            lists = b.column(3)
            raw = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(raw[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "tokens").mapInArrow(
        digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token stream of ``documents``: per document its start, length and checksum."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = write_token_orc(docs, fresh_path(spark, "token-orc"), default_tokenizer())
    return stream_digest(read_token_orc(spark, path))
