"""SentencePiece encoding and decoding through a table of distinct chunks, without a shuffle."""

import functools
import hashlib
import re

import pyarrow as pa
import sentencepiece

from .common import bare, flushed, rows_of

#: Fixed value: the character that stands for a space inside pieces.
MARK = "▁"
#: Entries after which a task starts its table anew, and longest chunk that is kept in it; both bound a worker's memory, neither changes a result.
TABLE_ENTRIES = 400_000
KEPT_CHARS = 256

_BORDER = re.compile(f"(?<=[^{MARK}])(?={MARK})")
_CROSSES = re.compile(f"[^{MARK}]{MARK}")


class Model:
    """One model and what its pieces allow.

    ``splits`` is true if no piece holds a whitespace marker behind another character. Then no merge can reach over the border before a
    marker, whatever stands on both sides, and each stretch from one marker (or run of them) to the next is segmented by itself.
    """

    def __init__(self, path):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        probe = "".join(self.library.encode_as_pieces(" ﬁ  x "))
        self.splits = not any(map(_CROSSES.search, pieces)) and probe == f"{MARK}{MARK}ﬁ{MARK}{MARK}x{MARK}"
        self.mark = self.library.piece_to_id(MARK)

    def chunks(self, text):
        """The chunks of a text in order, each without the marker it begins with; an empty text has none.

        The library sets one marker before every text, so a chunk without its first marker is a text that the library segments as it
        segments the chunk.
        """
        if not text:
            return []
        if not self.splits:
            return [text]
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [c[1:] for c in _BORDER.split(MARK + text.replace(" ", MARK))]

    def segment(self, chunks):
        """Ids of each chunk; a lone marker is the one chunk that the library does not see as a text."""
        ids = self.library.encode(chunks, num_threads=1) if chunks else []
        return [i if c or not self.splits else [self.mark] for c, i in zip(chunks, ids)]


@functools.lru_cache(maxsize=4)
def load(path):
    """One model per worker process."""
    return Model(path)


class ChunkTable:
    """Distinct chunks and a value for each: a chunk is segmented once, and its value is read at each of its positions.

    ``values_of`` turns the id lists of new chunks into their values, many at a time.
    """

    def __init__(self, model, values_of):
        self.model, self.values_of, self.entries = model, values_of, {}

    def values(self, text):
        """The values of a text's chunks, by position."""
        if len(self.entries) > TABLE_ENTRIES:
            self.entries = {}
        known, chunks = self.entries, self.model.chunks(text)
        new = list(set(chunks).difference(known))
        if new:
            known.update(zip(new, self.values_of(self.model.segment(new))))
        found = list(map(known.__getitem__, chunks))
        for c in new:
            if len(c) > KEPT_CHARS:
                del known[c]
        return found


def encode(docs, path, id_col="doc_id", text_col="text"):
    """Ids of every whole text: ``doc_id, ids``, as the library gives them, without begin or end ids and without sampling.

    Method: a text is cut before each whitespace marker, or run of them, that follows another character. No piece of the model spans such
    a place (checked when the model is loaded; a model with such pieces gets whole texts as chunks). Tasks hold a table of distinct
    chunks, segment each chunk once when it is first met, and join the ids back by position.

    NULL and empty texts give an empty list. NULL or repeated ids and repeated rows stay as they are; extra columns are left out; an
    empty table gives an empty table. A task holds one text with its ids and a table of bounded size.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        table = ChunkTable(load(path), lambda ids: ids)
        for batch in batches:
            yield from flushed(((i, [k for ids in table.values(t) for k in ids]) for i, t in rows_of(batch, "doc_id", "text")), schema, 64)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded, path):
    """Texts of id lists: ``doc_id, text``; a NULL list gives NULL, an empty one the empty text.

    Ids are cut before each piece that begins with a marker after one that does not end with one, and each distinct stretch is decoded once.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        model, known = load(path), {}
        starts = [model.splits and p.startswith(MARK) for p in map(model.library.id_to_piece, range(model.library.vocab_size()))]

        def text_of(ids):
            parts, part = [], []
            for i in ids:
                if part and starts[i] and not starts[part[-1]]:
                    parts.append(tuple(part))
                    part = []
                part.append(i)
            if part:
                parts.append(tuple(part))
            if len(known) > TABLE_ENTRIES:
                known.clear()
            for p in set(parts).difference(known):
                known[p] = model.library.decode(list(p))
            found = " ".join(map(known.__getitem__, parts))
            for p in parts:
                if len(p) > KEPT_CHARS:
                    known.pop(p, None)
            return found

        for batch in batches:
            yield from flushed(((i, None if ids is None else text_of(ids)) for i, ids in rows_of(batch, "doc_id", "ids")), schema, 64)

    return encoded.mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs, path, id_col="doc_id", text_col="text"):
    """Digests of encoding and decoding in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    The same as ``encode`` and then ``decode`` of its ids, with the decimal ids and the decoded text of each distinct chunk in the table.
    Edge cases as there.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        model = load(path)
        decimal = list(map(str, range(model.library.vocab_size())))
        table = ChunkTable(model, lambda many: [(len(ids), ",".join(map(decimal.__getitem__, ids)), text)
                                                for ids, text in zip(many, model.library.decode(many, num_threads=1))])

        def digest(doc_id, text):
            counts, ids, texts = zip(*found) if (found := table.values(text)) else ((), (), ())
            return (doc_id, sum(counts), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                    hashlib.sha256(" ".join(texts).encode()).hexdigest())

        for batch in batches:
            yield from flushed((digest(i, t) for i, t in rows_of(batch, "doc_id", "text")), schema, 512)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
