"""Token-ID output (operator 2): Arrow stream files of equal-length sequences and masks.

Documents are range-partitioned by id, encoded once in their partition, and packed into
rows of ``seq_len`` ids.  Each partition writes two Arrow IPC stream files:

* ``part-NNNNN.arrows``: record batches of ``input_ids`` (fixed-size list of the narrowest
  unsigned type that holds the vocabulary) and ``mask`` (fixed-size list of booleans, false
  on the padding of a file's last row).  Rows have one width, so a memory-mapped file gives
  any sequence by its number without copying.
* ``part-NNNNN.docs.arrows``: doc_id, first token in the file, number of tokens.

A file appears under its name only when complete, and its content depends only on its
partition, so a retried task replaces nothing half-written.

Defined results: a null or empty text is the end id alone; null doc_ids come first; equal
ids are ordered by a hash of their text; very long texts span as many rows as they need;
an empty table gives an empty result.  Ids are cast to long: an id that is text and no
number fails the job (in Spark's ANSI mode, its default).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkernels as tk
from .common import giving_back, ship_package, work_dir, written

SEQ_LEN = 2048
ROWS_PER_BATCH = 64
MOST_PIECES = 1_000_000  # bounds of a worker's memory of pieces: how many,
POOL_BYTES = 64 << 20  # their ids and bytes,
LONGEST_PIECE = 64  # and the bytes of one
_ENCODERS: dict[str, PieceEncoder] = {}


class _Buffer:
    """A growing array; room doubles, so appending never copies more than it adds on average."""

    def __init__(self, dtype):
        self.data, self.n = np.zeros(1024, dtype), 0

    def view(self) -> np.ndarray:
        return self.data[: self.n]

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.data):
            room = np.zeros(max(n, 2 * len(self.data)), self.data.dtype)
            room[: self.n] = self.view()
            self.data = room
        self.data[self.n : n] = values
        self.n = n


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    upto = np.cumsum(sizes)
    return np.arange(upto[-1] if len(upto) else 0) + np.repeat(starts - (upto - sizes), sizes)


class PieceEncoder:
    """Encodes texts with a ``tokenizers`` file, remembering the ids of pieces seen before.

    Byte-level pre-tokenization cuts before a run of white space, before the run's last
    character if a word follows, and after that character unless it is a space.  A text's
    ids are those of its pieces between these cuts, in order.  Runs with white space beyond
    ASCII are not cut, and a text that holds an added token of the vocabulary is one piece.
    Pieces are found, hashed and put together again as arrays; only unknown ones become
    strings.  These are encoded together, joined by what separates them anyway, and told
    apart by the ids that begin a piece.  A hash never stands for a piece unseen: bytes are
    compared, within a chunk and with what is remembered.

    A piece of more than ``LONGEST_PIECE`` bytes is never remembered, and beyond
    ``MOST_PIECES`` pieces or ``POOL_BYTES`` bytes the less used ones are forgotten, so what a worker
    keeps does not grow with the corpus.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True  # tokens that begin with a space
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self._clear()

    def _clear(self) -> None:
        """rows: piece hash to number k; a piece's ids are pool[starts[k] : starts[k] + sizes[k]], its bytes text[places[k] : places[k] + lengths[k]]."""
        self.rows: dict[int, int] = {}
        self.starts, self.sizes, self.places, self.lengths, self.uses = (_Buffer(np.int64) for _ in range(5))
        self.pool, self.text = _Buffer(self.dtype), _Buffer(np.uint8)

    def held_bytes(self) -> int:
        """Bytes of ids and pieces that are remembered."""
        return self.pool.n * self.dtype.itemsize + self.text.n

    def _remember(self, hashes: list[int], sizes: np.ndarray, ids: np.ndarray, lengths: np.ndarray, text: np.ndarray) -> None:
        base = self.starts.n
        self.rows.update(zip(hashes, range(base, base + len(hashes)), strict=True))
        self.starts.add(self.pool.n + np.cumsum(sizes) - sizes)
        self.places.add(self.text.n + np.cumsum(lengths) - lengths)
        self.sizes.add(sizes)
        self.lengths.add(lengths)
        self.uses.add(np.zeros(len(hashes), np.int64))
        self.pool.add(ids)
        self.text.add(text)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_pieces(self, pieces: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """The pieces in an order of their own: their numbers, how many ids each has, and all ids."""
        kinds: list[list[int]] = [[], [], []]  # space-led words, bare words, others
        for k, p in enumerate(pieces):
            word = p[1:] if p[:1] == " " else p
            kinds[2 if word.split() != [word] else word is p].append(k)
        sizes, flat = [], []
        for kind, between in ((0, ""), (1, "\n")):
            for lo in range(0, len(kinds[kind]), 4096):
                some = [pieces[k] for k in kinds[kind][lo : lo + 4096]]
                ids = self._ids([between.join(some)])[0]
                if kind == 0:
                    size = np.diff(np.append(np.flatnonzero(self.leads[ids]), len(ids)))
                else:
                    gap = ids == self.line[0]
                    size = np.diff(np.concatenate([[-1], np.flatnonzero(gap), [len(ids)]])) - 1
                    ids = ids[~gap]
                if len(size) != len(some) or len(self.line) != 1:  # a piece held a separator's id
                    parts = self._ids(some)
                    size, ids = np.array([len(x) for x in parts]), np.concatenate(parts)
                sizes.append(size)
                flat.append(ids)
        parts = self._ids([pieces[k] for k in kinds[2]])
        sizes.append(np.array([len(x) for x in parts], np.int64))
        return kinds[0] + kinds[1] + kinds[2], np.concatenate(sizes).astype(np.int64), np.concatenate([*flat, *parts, np.zeros(0, self.dtype)])

    def _forget(self) -> None:
        """Keep the more used half of what the bounds allow, by use and then by age."""
        uses, weight = self.uses.view(), self.sizes.view() * self.dtype.itemsize + self.lengths.view()
        order = np.argsort(-uses, kind="stable")[: MOST_PIECES // 3]
        order = order[np.cumsum(weight[order]) <= POOL_BYTES // 2]
        keep = np.sort(order[uses[order] > 1])
        number = np.full(len(uses), -1, np.int64)
        number[keep] = np.arange(len(keep))
        hashes = sorted(((int(number[r]), h) for h, r in self.rows.items() if number[r] >= 0))
        sizes, lengths = self.sizes.view()[keep], self.lengths.view()[keep]
        ids = self.pool.view()[_spans(self.starts.view()[keep], sizes)]
        text = self.text.view()[_spans(self.places.view()[keep], lengths)]
        self._clear()
        self._remember([h for _, h in hashes], sizes, ids, lengths, text)
        self.uses.view()[:] = 1

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of all pieces of a chunk's rows (at least one for each row that is not empty)."""
        n = len(data)
        blank = tk.IS_SPACE[data]
        odd = (data >= 0x1C) & (data <= 0x1F)  # white space to some, not to all
        wide = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
        one, two = data[np.minimum(wide + 1, n - 1)], data[np.minimum(wide + 2, n - 1)]
        lead = data[wide]
        short = (lead == 0xC2) & ((one == 0x85) | (one == 0xA0))
        long = (lead == 0xE1) & (one == 0x9A) & (two == 0x80) | (lead == 0xE3) & (one == 0x80) & (two == 0x80)
        long |= (lead == 0xE2) & ((one == 0x81) & (two == 0x9F) | (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)))
        for k in range(3):
            odd[np.minimum(wide[long] + k, n - 1)] = True
        for k in range(2):
            odd[np.minimum(wide[short] + k, n - 1)] = True
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        # runs of white space within a row: [first, last]
        space = blank | odd
        opens, closes = space.copy(), space.copy()
        opens[1:] &= ~space[:-1] | edge[1:-1]
        closes[:-1] &= ~space[1:] | edge[1:-1]
        first, last = np.flatnonzero(opens), np.flatnonzero(closes)
        spoilt = np.append(0, np.cumsum(odd))
        pure = spoilt[last + 1] == spoilt[first]
        first, last = first[pure], last[pure]
        followed = ~edge[last + 1]
        start = edge[:n].copy()
        start[first] = True
        start[last[followed]] = True
        after = last[followed & (data[last] != 0x20)] + 1
        start[after] = True
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                r = int(np.searchsorted(offsets, at, "right")) - 1
                start[offsets[r] + 1 : offsets[r + 1]] = False
                at = raw.find(token, int(offsets[r + 1]))
        return np.flatnonzero(start)

    def _known(self, keys: list[int], data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The remembered number of each piece, -1 for none, -2 where another piece has its hash."""
        row = np.array([self.rows.get(k, -1) for k in keys], np.int64)
        met = np.flatnonzero(row >= 0)
        r = row[met]
        same = self.lengths.view()[r] == lengths[met]
        row[met[~same]] = -2
        met, r = met[same], r[same]
        own, kept = data[_spans(starts[met], lengths[met])], self.text.view()[_spans(self.places.view()[r], lengths[met])]
        wrong = np.unique(np.repeat(np.arange(len(met)), lengths[met])[own != kept])
        row[met[wrong]] = -2
        return row

    def encode(self, column: pa.Array, end_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of the column's rows: their ids, each row closed by ``end_id``, and the number of ids of each row."""
        for _, data, offsets in tk.chunks(column, 2 << 20):
            n = len(offsets) - 1
            if not len(data):
                yield np.full(n, end_id, self.dtype), np.ones(n, np.int64)
                continue
            starts = self._pieces(data, offsets)
            lengths = np.diff(np.append(starts, len(data)))
            h = tk.mix(tk.word_hashes(data, starts, starts + lengths) ^ lengths.astype(np.uint64))
            distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
            alike = lengths[first[back]] == lengths
            if not alike.all() or not np.array_equal(data[_spans(starts[first[back]], lengths)], data):
                # two pieces of the chunk have one hash: number the pieces by their bytes
                raw, seen = data.tobytes(), {}
                h = np.array([seen.setdefault(raw[a : a + k], len(seen)) for a, k in zip(starts.tolist(), lengths.tolist(), strict=True)], np.uint64)
                distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
            if len(self.rows) + len(distinct) > MOST_PIECES or self.held_bytes() > POOL_BYTES:
                self._forget()
            keys, at, size = distinct.tolist(), starts[first], lengths[first]
            row = self._known(keys, data, at, size)
            brief = size <= LONGEST_PIECE
            raw = data.tobytes() if (row < 0).any() else b""
            base, text_base = (self.starts.n, self.pool.n), self.text.n
            for keep in (True, False):  # what is only used here comes last and goes again
                new = np.flatnonzero((row == -1) & brief if keep else (row == -2) | (row == -1) & ~brief)
                if not len(new):
                    continue
                order, sizes, ids = self._encode_pieces([raw[x : x + k].decode() for x, k in zip(at[new].tolist(), size[new].tolist(), strict=True)])
                new = new[order]
                row[new] = self.starts.n + np.arange(len(new))
                self._remember([keys[k] for k in new.tolist()] if keep else [-1 - k for k in range(len(new))], sizes, ids, size[new], data[_spans(at[new], size[new])])
                if keep:
                    base, text_base = (self.starts.n, self.pool.n), self.text.n
            self.uses.view()[row] += 1
            of = row[back]
            counts = self.sizes.view()[of]
            ids = self.pool.view()[_spans(self.starts.view()[of], counts)]
            for k in range(self.starts.n - base[0]):
                del self.rows[-1 - k]
            for b in (self.starts, self.sizes, self.places, self.lengths, self.uses):
                b.n = base[0]
            self.pool.n, self.text.n = base[1], text_base
            tokens_before = np.append(0, np.cumsum(counts))[np.searchsorted(starts, offsets)]
            yield np.insert(ids, tokens_before[1:], end_id), np.diff(tokens_before) + 1


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _schema(dtype: np.dtype, seq_len: int) -> pa.Schema:
    return pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


class _Packer:
    """Appends ids to an Arrow stream file, row by row of ``seq_len`` ids."""

    def __init__(self, sink, dtype: np.dtype, seq_len: int):
        self.schema, self.dtype, self.seq_len = _schema(dtype, seq_len), dtype, seq_len
        self.writer, self.held, self.n_held, self.n_tokens = pa.ipc.new_stream(sink, self.schema), [], 0, 0
        self.full = seq_len * ROWS_PER_BATCH * dtype.itemsize

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_tokens += len(ids) // self.dtype.itemsize
        if self.n_held >= self.full:
            data = b"".join(self.held)
            for at in range(0, len(data) - self.full + 1, self.full):
                self._write(np.frombuffer(data, self.dtype, self.full // self.dtype.itemsize, at), None)
            self.held = [data[len(data) - len(data) % self.full :]]
            self.n_held = len(self.held[0])

    def _write(self, ids: np.ndarray, n: int | None) -> None:
        mask = np.ones(len(ids), bool)
        if n is not None:
            mask[n:] = False
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        if len(ids):
            rows = -(-len(ids) // self.seq_len)
            self._write(np.concatenate([ids, np.zeros(rows * self.seq_len - len(ids), self.dtype)]), len(ids))
        self.writer.close()


def _finish(store: fs.FileSystem, temporary: str, final: str) -> None:
    if store.get_file_info(final).type == fs.FileType.File:
        store.delete_file(temporary)  # an earlier attempt of this task finished
    else:
        store.move(temporary, final)


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, seq_len: int = SEQ_LEN, end_id: int = 0, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write; returns the manifest (part, base, n_tokens, n_docs), parts in ascending id order."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(tokenizer_file), TaskContext.get().partitionId()
        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        names = [f"{folder}/part-{part:05d}.arrows", f"{folder}/part-{part:05d}.docs.arrows"]
        drafts = [f"{folder}/.{uuid.uuid4().hex}" for _ in names]
        ids, firsts, counts, packer, sink = [], [], [], None, None
        for b in batches:
            if packer is None:
                sink = store.open_output_stream(drafts[0])
                packer = _Packer(sink, enc.dtype, seq_len)
            ids.append(b.column(0))
            for found, n in enc.encode(b.column(1), end_id):
                firsts.append(packer.n_tokens + np.cumsum(n) - n)
                counts.append(n)
                packer.add(found.tobytes())
        if packer is None:
            return
        packer.close()
        sink.close()
        docs_table = pa.table({"doc_id": pa.chunked_array(ids), "first": np.concatenate(firsts), "n_tokens": np.concatenate(counts)})
        with store.open_output_stream(drafts[1]) as out, pa.ipc.new_stream(out, docs_table.schema) as w:
            w.write_table(docs_table.combine_chunks())
        for draft, name in zip(drafts, names, strict=True):
            _finish(store, draft, name)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_tokens": pa.array([packer.n_tokens], pa.int64()), "n_docs": pa.array([docs_table.num_rows], pa.int64())})

    parts = written(ranged.mapInArrow(giving_back(run), "part int, n_tokens long, n_docs long"), "token-manifest")
    # one row per file: the running total is over the manifest, not over documents
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_tokens(path: str, part: int) -> tuple[pa.Table, pa.Table]:
    """A part's sequences and documents; memory-mapped, so that nothing is copied, where the store is local."""
    store, folder = fs.FileSystem.from_uri(path)
    tables = []
    for kind in ("arrows", "docs.arrows"):
        name = f"{folder}/part-{part:05d}.{kind}"
        source = pa.memory_map(name) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(name)
        tables.append(pa.ipc.open_stream(source).read_all())
    return tables[0], tables[1]


def sequence(tokens: pa.Table, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
    """Ids and mask of the k-th sequence, both views of the file (the mask is an Arrow array over its bits)."""
    batch, k = divmod(k, ROWS_PER_BATCH)
    ids, mask = (tokens.column(c).chunk(batch) for c in (0, 1))
    n = ids.type.list_size
    return ids.values.to_numpy(zero_copy_only=True)[k * n : (k + 1) * n], mask.values.slice(k * n, n)


def read_documents(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, first) of each document, from the files."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens, docs = open_tokens(path, part)
                chunks = [c.values.to_numpy() for c in tokens.column(0).chunks]
                width = len(chunks[0])
                firsts, counts = docs.column(1).to_numpy(), docs.column(2).to_numpy()
                crcs = np.empty(len(firsts), np.int64)
                for i, (a, n) in enumerate(zip(firsts.tolist(), counts.tolist(), strict=True)):
                    crc = 0
                    while n:  # a document may cross record batches
                        k, at = divmod(a, width)
                        piece = chunks[k][at : at + n]
                        crc = zlib.crc32(piece.astype("<u4").tobytes(), crc)
                        a, n = a + len(piece), n - len(piece)
                    crcs[i] = crc
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays(docs.column(0).chunks), pa.array(firsts + base), pa.array(counts), pa.array(crcs), pa.array(np.full(len(firsts), part, np.int32)), pa.array(firsts)],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "part", "first"],
                )

    return manifest.select("part", "base").repartitionByRange(max(1, manifest.count()), "part").mapInArrow(giving_back(run), "doc_id long, start long, n_tokens long, ids_crc32 long, part int, first long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_to_files(docs: DataFrame, tokenizer_file: str | None = None, seq_len: int = SEQ_LEN) -> DataFrame:
    """Write ``docs`` to a fresh folder of token files and read every document's ids back."""
    path = work_dir(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, path, tokenizer_file or default_tokenizer(), seq_len)
    return read_documents(manifest, path)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_to_files(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
