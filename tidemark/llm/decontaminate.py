"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items."""

import functools
import hashlib
import pickle
import re
import zlib

import ahocorasick
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import settle
from .common import bare, batch_of, flushed, rows_of, unused

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: UTF-8 bytes of items in one automaton; more items than that make further ones. Windows of an item in one piece of it.
BLOCK_BYTES, PIECE = 4 << 20, 4096
#: Bytes of rows that a task holds while it takes one automaton after another.
HELD_BYTES = 64 << 20

#: A-Z to a-z, ASCII letters, digits and every byte above ASCII are word bytes, the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    """Normalised words of a text as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Automaton:
    """All windows of a block of items; a match names its window, which names its items and its number of words.

    Words are symbols: each distinct word of the block is one character, so the machine has a state for a word, not for a letter.
    """

    def __init__(self, items, size=WINDOW):
        holders, self.symbols = {}, {}
        for item, item_words in items:
            for w in item_words:
                self.symbols.setdefault(w, chr(len(self.symbols) + 1))
            for i in range(max(1, len(item_words) - size + 1) if item_words else 0):
                holders.setdefault("".join(map(self.symbols.__getitem__, item_words[i:i + size])), set()).add(item)
        self.items = [frozenset(h) for h in holders.values()]
        self.lengths = [len(w) for w in holders]
        self.machine = ahocorasick.Automaton()
        for k, w in enumerate(holders):
            self.machine.add_word(w, k)
        if holders:
            self.machine.make_automaton()

    def matches(self, text_words):
        """(first word, one past the last word, window) of every occurrence, overlapping ones too."""
        if not self.items or not text_words:
            return []
        symbol = self.symbols.get
        text = "".join([symbol(w, "\0") for w in text_words])  # no window holds a word that the block lacks
        return [(at + 1 - self.lengths[k], at + 1, k) for at, k in self.machine.iter(text)]


def merged(intervals):
    """Union of word intervals, in order."""
    out = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def spans_of(text, intervals):
    """Character spans in the original text of word intervals."""
    if not intervals:
        return []
    places = [m.span() for m in _WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in intervals]


def _pieces(items, size):
    """``item_id, words`` of stretches of PIECE windows of an item, so that one long item does not make a long block."""
    schema = pa.schema([("item_id", pa.string()), ("words", pa.binary())])

    def run(batches):
        for batch in batches:
            yield from flushed(((item, b" ".join(w[i:i + PIECE + size - 1])) for item, text in rows_of(batch, "item_id", "text")
                                for w in [words(text)] if w for i in range(0, max(1, len(w) - size + 1), PIECE)), schema)

    named = items.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).withColumn("item_id", F.col("item_id").cast("string"))
    return settle(named.select("item_id", "text").mapInArrow(run, "item_id string, words binary"), "items")


def _blocks(items, size, block_bytes):
    """Broadcasts of the items in blocks of bounded size, packed; one block at a time is on the driver.

    Pieces are dealt to blocks by hash, as many blocks as their measured size asks for.
    """
    pieces = _pieces(items, size)
    total = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = 2 * total // block_bytes + 1 if total > block_bytes else 1
    out = []
    for k in range(n):
        block = pieces.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k) if n > 1 else pieces
        held = sorted((r[0], bytes(r[1])) for r in block.collect())
        packed = zlib.compress(pickle.dumps(held))
        out.append((hashlib.sha256(packed).hexdigest(), items.sparkSession.sparkContext.broadcast(packed)))
    return out


@functools.lru_cache(maxsize=1)
def _automaton(key, packed, size):
    return Automaton([(item, own.split()) for item, own in pickle.loads(zlib.decompress(packed))], size)


def _held(batches, most):
    """Lists of Arrow batches of about ``most`` bytes or one batch."""
    held, total = [], 0
    for batch in batches:
        if held and total + batch.nbytes > most:
            yield held
            held, total = [], 0
        held.append(batch)
        total += batch.nbytes
    if held:
        yield held


def _scanned(docs, text_col, blocks, size, own):
    """``docs`` with the columns ``own``_n, ``own``_hits and ``own``_items: one pass, in which a task takes the blocks one after another.

    With one block its automaton stays in the worker and batches pass through. With more, a task holds up to HELD_BYTES of rows, walks all blocks
    over them, there and back in turn, with one automaton at a time, and carries hits only.
    """
    pair = pa.struct([("first", pa.int32()), ("past", pa.int32())])
    found = pa.schema([(f"{own}_n", pa.int64()), (f"{own}_hits", pa.list_(pair)), (f"{own}_items", pa.list_(pa.string()))])
    ddl = f"`{own}_n` bigint, `{own}_hits` array<struct<first: int, past: int>>, `{own}_items` array<string>"
    schema = StructType([*docs.schema.fields, *docs.sparkSession.createDataFrame([], ddl).schema.fields])
    names = docs.columns

    def run(batches):
        order = list(blocks)
        for held in _held(batches, HELD_BYTES if len(blocks) > 1 else 0):
            n = [[0] * b.num_rows for b in held]
            hits, items = ([[()] * b.num_rows for b in held] for _ in range(2))
            for key, shared in order:
                machine = _automaton(key, shared.value, size)
                for k, batch in enumerate(held):
                    for i, (text,) in enumerate(rows_of(batch, text_col)):
                        text_words = words(text)
                        n[k][i] = len(text_words)
                        occurrences = machine.matches(text_words)
                        if occurrences:
                            hits[k][i] = merged([*map(tuple, hits[k][i]), *((a, b) for a, b, _ in occurrences)])
                            items[k][i] = frozenset(items[k][i]).union(*[machine.items[w] for w in {w for *_, w in occurrences}])
            order.reverse()  # the last automaton is the next one
            for k, batch in enumerate(held):
                more = batch_of(found, [(c, [dict(first=a, past=b) for a, b in h], sorted(of)) for c, h, of in zip(n[k], hits[k], items[k])])
                yield pa.RecordBatch.from_arrays([*batch.columns, *more.columns], names=[*names, *found.names])

    return docs.mapInArrow(run, schema)


def find(docs, benchmark, size=WINDOW, block_bytes=BLOCK_BYTES, text_col="text", item_col="item_id", item_text_col="text"):
    """``docs`` with three more columns and their common stem: words, hit word intervals, matching items.

    The benchmark is the query set: it is broadcast in packed blocks of a measured size, and every text is read once.
    Nothing is shuffled or written between blocks, and no task holds more than one automaton.
    """
    own = unused(docs.columns, "__found")
    return _scanned(docs, text_col, _blocks(bare(benchmark, item_id=item_col, text=item_text_col), size, block_bytes), size, own), own


def _judged(own):
    n, hits, items = (F.col(f"{own}_{x}") for x in ("n", "hits", "items"))
    hit = F.aggregate(hits, F.lit(0).cast("bigint"), lambda s, h: s + (h["past"] - h["first"]))
    return {"n_words": n, "n_hit": hit, "n_items": F.size(items).cast("bigint"),
            "items_sha256": F.sha2(F.array_join(items, ","), 256),
            "contaminated": (hit > 0) & (20 * hit >= n)}


def scan(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every whole text.

    A word is hit if an occurrence of a window covers it; a text is contaminated if a twentieth of its words or more
    are hit. NULL and empty texts have no words and no hits. Items that are NULL, have no words or a NULL id match
    nothing; equal items under several ids all count, a repeated row of one id counts once. Repeated documents and
    NULL ids stay. Extra columns on either side are left out. Either side may be empty.
    """
    found, own = find(bare(docs, doc_id=id_col, text=text_col), benchmark, **options)
    return found.select("doc_id", *[c.alias(n) for n, c in _judged(own).items()])


def passages(docs, benchmark, id_col="doc_id", text_col="text", **options):
    """``doc_id, start, end_at, items`` of every hit stretch, in characters of the original text."""
    found, own = find(bare(docs, doc_id=id_col, text=text_col), benchmark, **options)
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end_at", pa.int32()), ("items", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            yield from flushed(((i, a, b, items) for i, text, hits, items in rows_of(batch, "doc_id", "text", f"{own}_hits", f"{own}_items")
                                for a, b in spans_of(text, [(h["first"], h["past"]) for h in hits])), schema)

    return found.where(F.size(f"{own}_hits") > 0).mapInArrow(run, "doc_id bigint, start int, end_at int, items array<string>")


def clean(docs, benchmark, **options):
    """The rows of ``docs`` that are not contaminated, all columns as they were. Edge cases as in ``scan``."""
    found, own = find(docs, benchmark, **options)
    return found.where(~_judged(own)["contaminated"]).select(*[f"`{c}`" for c in docs.columns])
