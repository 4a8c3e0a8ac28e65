"""Byte-level BPE encoding and decoding by tree reduction, row by row without a shuffle."""

import functools
import hashlib
from itertools import chain

import pyarrow as pa
import regex

from . import bpe
from .common import bare, flushed, rows_of

LEAF_BYTES = 1024
#: Chunks whose ids a worker keeps in a generation.
CACHE_ENTRIES = 150_000


class _Chunks(dict):
    """Ids of recent chunks in two generations: the older one goes when the younger is full."""

    def __init__(self, vocabulary, pattern, leaf):
        self.vocabulary, self.pattern, self.leaf, self.older = vocabulary, regex.compile(pattern), leaf, {}

    def __missing__(self, chunk):
        v = self.vocabulary
        if len(chunk) > 64:
            return tuple(chain.from_iterable(v.piece(m.encode(), self.leaf) for m in self.pattern.findall(chunk)))
        ids = self.older.get(chunk)
        if ids is None:
            ids = tuple(v.library._core_bpe.encode_ordinary(chunk))
        if len(self) >= CACHE_ENTRIES:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


@functools.lru_cache(maxsize=4)
def _chunks(path, pattern, leaf):
    return _Chunks(bpe.load(path, pattern), pattern, leaf)


def encode_text(text, path, pattern=bpe.PATTERN, leaf=LEAF_BYTES):
    """Ids of one text, special strings read as ordinary text."""
    return list(chain.from_iterable(map(_chunks(path, pattern, leaf).__getitem__, bpe.cuts(text)))) if text else []


def encode(docs, path, pattern=bpe.PATTERN, leaf=LEAF_BYTES, id_col="doc_id", text_col="text"):
    """Token ids of every whole text: ``doc_id, ids``.

    Method: a text is cut where no token can cross, which needs no re-encoding at the joint. A stretch without
    such a place is matched by the pattern; a match longer than ``leaf`` bytes is halved recursively and the halves'
    tokens are joined by encoding growing windows around the border until both window borders are stable
    (``bpe.Bpe.join``). Results equal the library's for every text.

    NULL and empty texts give an empty list. NULL or repeated ids and repeated rows are kept as they are; extra
    columns are left out. An empty table gives an empty table. One row's text and ids are in memory at a time.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, encode_text(t, path, pattern, leaf)) for i, t in rows_of(batch, "doc_id", "text")), schema, 64)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded, path, pattern=bpe.PATTERN):
    """Bytes of every id list: ``doc_id, data``; a NULL list gives NULL, an empty one no bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("data", pa.binary())])

    def run(batches):
        vocabulary = bpe.load(path, pattern)
        for batch in batches:
            yield from flushed(((i, None if ids is None else vocabulary.decode(ids)) for i, ids in rows_of(batch, "doc_id", "ids")), schema, 64)

    return encoded.mapInArrow(run, "doc_id bigint, data binary")


def round_trip(docs, path, pattern=bpe.PATTERN, leaf=LEAF_BYTES, with_ids=False, id_col="doc_id", text_col="text"):
    """Digest of encoding and decoding in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if asked for.

    The same as ``encode`` and then ``decode`` of its ids, without writing the ids between. Edge cases as there.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema([*fields, *[("ids", pa.list_(pa.int32()))] * with_ids])

    def run(batches):
        vocabulary = bpe.load(path, pattern)
        decimal = [str(i) for i in range(len(vocabulary.bytes_of))]

        def digest(doc_id, text):
            ids = encode_text(text, path, pattern, leaf)
            return (doc_id, len(ids), hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(vocabulary.decode(ids)).hexdigest(), *[ids] * with_ids)

        for batch in batches:
            yield from flushed((digest(i, t) for i, t in rows_of(batch, "doc_id", "text")), schema, 64)

    return bare(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
