"""SentencePiece by a table of distinct marked words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronicle.llm.kernels import filled, layout, slices

MARK = "▁"
#: What the distinct marked words that a task keeps, with their ids, may take; beyond it the table starts anew.
TABLE_BYTES = 32 << 20
#: What a word takes besides its characters and ids.
_WORD_BYTES = 120
#: Text that is cut into marked words at a time.
PART_BYTES = 1 << 20
#: Probes for the rules under which marked words may be segmented alone.
_PROBES = ("a  b ", "  a", "é", "é", "ﬁ", "　", " ", "a\tb\nc", "Ａ", "İ", "½", "​")


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def is_separable(processor) -> bool:
    """Whether marked words can be segmented alone: no piece has a mark behind
    another character, and the text is otherwise left as it is."""
    pieces = (processor.id_to_piece(i) for i in range(processor.get_piece_size()))
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return False
    return all(processor.normalize(p) == MARK + p.replace(" ", MARK) for p in _PROBES)


def marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The marked words of all texts in order, without their first mark, and how many each text has.

    A marked word is a run of marks (blanks) with all that follows up to the
    next blank; the mark before a text's beginning belongs to its first word.
    """
    offsets, data = layout(texts)
    if (data == 0xE2).any():
        texts = pc.replace_substring(texts, MARK, " ")
        offsets, data = layout(texts)
    blank = np.zeros(len(data) + 1, bool)
    blank[1:] = data == 32
    cut = blank[1:] & ~blank[:-1]
    filled_rows = np.diff(offsets) > 0
    heads = offsets[:-1][filled_rows]
    cut[heads] = False
    cuts = np.flatnonzero(cut)
    starts = np.concatenate((cuts + 1, heads))
    starts = starts[np.argsort(starts, kind="stable")]
    kept = np.delete(data, cuts)
    ends = np.empty(len(starts) + 1, np.int32)
    ends[:-1] = starts - np.searchsorted(cuts, starts)
    ends[-1] = len(kept)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(kept))
    per_row = filled_rows + np.diff(np.searchsorted(cuts, offsets))
    return words, per_row


class WordTable:
    """Ids of the distinct marked words met so far; each is segmented once."""

    def __init__(self, model: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.separable = is_separable(self.processor)
        self.mark = self.processor.piece_to_id(MARK)
        self._clear()

    def _clear(self):
        self.slots, self.ids, self.ends, self.bytes = {}, np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def _learn(self, words: list[str]) -> np.ndarray:
        """The slots of distinct ``words``, after segmenting those that are new."""
        if self.bytes > TABLE_BYTES:
            self._clear()
        new = [w for w in words if w not in self.slots]
        if new:
            found = self.processor.encode(new, num_threads=1)
            if self.separable and "" in new:
                found[new.index("")] = [self.mark]  # a mark alone
            self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum()))
            self.ids = np.concatenate((self.ids, flat))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(sizes)))
            # A string has up to four bytes a character.
            self.bytes += _WORD_BYTES * len(new) + 4 * sum(map(len, new)) + flat.nbytes
        return np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))

    def _places(self, texts: pa.Array):
        """For each marked word of ``texts`` the span of its ids, and how many words each text has."""
        if self.separable:
            words, per_row = marked_words(texts)
        else:
            words, per_row = texts, np.ones(len(texts), np.int64)
        encoded = words.dictionary_encode()
        slots = self._learn(encoded.dictionary.to_pylist())[encoded.indices.to_numpy()]
        starts = self.ends[slots]
        return starts, self.ends[slots + 1] - starts, np.concatenate(([0], np.cumsum(per_row)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        _, sizes, rows = self._places(texts)
        return np.diff(np.concatenate(([0], np.cumsum(sizes)))[rows])

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text: those of its marked words, joined by position."""
        starts, sizes, rows = self._places(texts)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        take = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        return pa.ListArray.from_arrays(pa.array(ends[rows], pa.int32()), pa.array(self.ids[take], pa.int32()))


def encoder(model: bytes):
    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = WordTable(model)
        for texts in batches:
            yield from map(table.encode, slices(filled(texts), PART_BYTES))

    return ids


def counter(model: bytes):
    @F.arrow_udf("long")
    def n_tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = WordTable(model)
        for texts in batches:
            for part in slices(filled(texts), PART_BYTES):
                yield pa.array(table.counts(part), pa.int64())

    return n_tokens


def _decoded(processor, lists: pa.Array) -> pa.Array:
    return pa.array([processor.decode(ids.as_py() or []) for ids in lists], pa.string())


def coder(model: bytes):
    """Encodes and decodes in one worker, which hands back small parts."""

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = WordTable(model)
        for texts in batches:
            for part in slices(filled(texts), PART_BYTES):
                ids = table.encode(part)
                yield pa.StructArray.from_arrays([ids, _decoded(table.processor, ids)], ["ids", "decoded"])

    return both


def decoder(model: bytes):
    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for lists in batches:
            yield _decoded(processor, lists)

    return text


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of every whole text, exactly as the library gives them.

    Each task cuts its texts into marked words, segments each distinct word once
    and joins the ids back by position; nothing is shuffled. With a model whose
    pieces cross marks, whole texts take the place of words. A null text
    counts as empty; an empty text has no ids.
    """
    return docs.withColumn(ids, encoder(read_model(model_path))(F.col(text)))


def decode(docs: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text that the library gives for the ids; null ids count as none."""
    return docs.withColumn(text, decoder(read_model(model_path))(F.col(ids)))


def round_trip(docs: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: ``encode``, then ``decode``, in one pass."""
    both = docs.withColumn("_coded", coder(read_model(model_path))(F.col(text)))
    return both.withColumn("ids", F.col("_coded.ids")).withColumn("decoded", F.col("_coded.decoded")).drop("_coded")
