"""Line dedup: repeated passages of whole lines stay once and go elsewhere."""

import hashlib

import pyarrow as pa
from pyspark.sql import functions as F

from ..session import settle
from .common import bare, flushed, row_key, rows_of, settle_text, unused

#: Words that a repeated passage must have to be removed.
PASSAGE_WORDS = 50
#: Prime modulus of the rolling hash.
MODULUS = (1 << 127) - 1


def chunks(text):
    """(number, line, one past it, words, text) of a text's chunks, in order: its lines but the blank ones, which part nothing.

    A chunk depends on no line beside it, so whatever stands before or after a passage, all of its lines are found.
    """
    filled = ((i, line, len(line.split())) for i, line in enumerate(text.split("\n")))
    return [(n, i, i + 1, words, line) for n, (i, line, words) in enumerate(x for x in filled if x[2])]


def windows(own, passage_words=PASSAGE_WORDS):
    """(first number, last number) of a text's shortest passages: the shortest stretch of chunks with enough words from each chunk on, and up to each.

    Any stretch with enough words is made up of those that lie in it.
    """
    out, total, b = set(), 0, 0
    for a in range(len(own)):
        while b < len(own) and total < passage_words:
            total += own[b][3]
            b += 1
        if total < passage_words:
            break
        out.add((a, b - 1))
        total -= own[a][3]
    total, a = 0, 0
    for b in range(len(own)):
        total += own[b][3]
        while total - own[a][3] >= passage_words:
            total -= own[a][3]
            a += 1
        if total >= passage_words:
            out.add((a, b))
    return sorted(out)


def _number(data, key):
    """A hash of bytes below the modulus, under a key."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=16, key=b"%d" % key).digest(), "big") % MODULUS


def rolling(lines, key=0):
    """Function of (a, b): the polynomial hash of the hashes of lines a to b, from the hashes of all beginnings, so in one step."""
    base, prefix, powers = _number(b"base", key), [0], [1]
    for line in lines:
        prefix.append((prefix[-1] * base + _number(line.encode("utf-8", "surrogatepass"), key)) % MODULUS)

    def of(a, b):
        while len(powers) <= b + 1 - a:
            powers.append(powers[-1] * base % MODULUS)
        return ((prefix[b + 1] - prefix[a] * powers[b + 1 - a]) % MODULUS).to_bytes(16, "big")

    return of


def occurrences(own, passage_words=PASSAGE_WORDS, key=0):
    """[digest, first number, last number, chunks] of a text's shortest passages; equal ones that overlap each other are one occurrence, from the first to
    the last of them, so that a passage is no repeat of itself. ``chunks`` counts those of the first of them."""
    lines = [c[4] for c in own]
    digest_of, out, last = rolling(lines, key), [], {}
    for a, b in windows(own, passage_words):
        digest = digest_of(a, b)
        at = last.get(digest)
        if at is not None and a <= out[at][2] and lines[out[at][1]:out[at][1] + out[at][3]] == lines[a:b + 1]:
            out[at][2] = max(out[at][2], b)
        else:
            last[digest] = len(out)
            out.append([digest, a, b, b + 1 - a])
    return out


def _passages(docs, passage_words, hash_key):
    """One narrow row for each occurrence of a shortest passage in a text, with the rolling hash over its lines' hashes."""
    schema = pa.schema([("row_key", pa.binary()), ("doc_id", pa.int64()), ("number", pa.int32()), ("until", pa.int32()), ("first", pa.int32()),
                        ("past", pa.int32()), ("size", pa.int32()), ("digest", pa.binary())])

    def run(batches):
        def found(key, doc_id, text):
            own = chunks(text)
            for digest, a, b, size in occurrences(own, passage_words, hash_key):
                yield key, doc_id, a, b, own[a][1], own[b][2], size, digest

        for batch in batches:
            yield from flushed((row for key, doc_id, text in rows_of(batch, "row_key", "doc_id", "text") for row in found(key, doc_id, text or "")), schema)

    return docs.mapInArrow(run, "row_key binary, doc_id bigint, number int, until int, first int, past int, size int, digest binary")


def merged(passages):
    """(first, past) line ranges of (number, until, first, past) passages; those that overlap or follow on each other are one range."""
    out = []
    for number, until, first, past in sorted(passages):
        if out and number <= out[-1][0] + 1:
            out[-1] = max(out[-1][0], until), out[-1][1], max(out[-1][2], past)
        else:
            out.append((until, first, past))
    return [(first, past) for _, first, past in out]


def without(ranges, kept):
    """The line ranges less the lines of ``kept`` ranges; both in order and apart."""
    out = []
    for first, past in ranges:
        for a, b in kept:
            if b <= first or a >= past:
                continue
            if a > first:
                out.append((first, a))
            first = max(first, b)
        if first < past:
            out.append((first, past))
    return out


def repeated_ranges(docs, passage_words=PASSAGE_WORDS, hash_key=0):
    """``row_key, ranges, spans`` of rows ``row_key, doc_id, text``: line ranges to remove, and (number, size, digest) of the passages counted as repeated.

    A line goes if it lies in a passage of ``passage_words`` words or more whose lines all follow on each other in one earlier place as
    well; lines that repeat here and there make none. That holds exactly if one of the shortest passages around it is repeated, so
    those are counted by a rolling hash over line hashes, in rows without text that are pre-aggregated before the shuffle. Where a passage begins and
    ends depends on its own lines only, whatever stands before or after it. Of equal passages
    the one in the smallest (id, text, place) stays, and its lines stay whatever other passages they lie in, so every repeated passage is left whole
    in one place. Equal passages that overlap in a text are one occurrence. A frequent line or passage makes one row for each time it occurs, no pairs.
    """
    found = settle_text(_passages(docs, passage_words, hash_key), "passages")
    # written before they are joined, so that both sides of the join are dealt and a hot digest can be split
    twice = settle(found.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"), "twice")
    again = settle_text(found.join(twice, "digest", "left_semi"), "repeated")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "number")
    kept = settle_text(again.groupBy("digest").agg(F.min(place).alias("kept")), "kept")
    columns = ["number", "until", "first", "past", "size", "digest"]
    placed = again.join(kept, "digest").select("row_key", (place != F.col("kept")).alias("later"), *columns).distinct()
    span = pa.struct([("number", pa.int32()), ("size", pa.int32()), ("digest", pa.binary())])
    schema = pa.schema([("row_key", pa.binary()), ("ranges", pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))), ("spans", pa.list_(span))])

    def run(batches):
        def ranges(own):
            later, kept = (merged((p["number"], p["until"], p["first"], p["past"]) for p in own if p["later"] == side) for side in (True, False))
            return [dict(first=a, past=b) for a, b in without(later, kept)]

        for batch in batches:
            yield from flushed(((key, ranges(own), [{k: p[k] for k in ("number", "size", "digest")} for p in own])
                                for key, own in rows_of(batch, "row_key", "own")), schema)

    gathered = placed.groupBy("row_key").agg(F.collect_list(F.struct("later", *columns)).alias("own"))
    return gathered.mapInArrow(run, "row_key binary, ranges array<struct<first: int, past: int>>, spans array<struct<number: int, size: int, digest: binary>>")


def unequal(marked):
    """Digests under which texts with ``spans`` hold different passages, by comparing the bytes of every place with those of the others."""
    schema = pa.schema([("digest", pa.binary()), ("passage", pa.string())])

    def run(batches):
        def passages(text, spans):
            lines = [c[4] for c in chunks(text)]
            for s in spans:
                yield s["digest"], "\n".join(lines[s["number"]:s["number"] + s["size"]])

        for batch in batches:
            yield from flushed((row for text, spans in rows_of(batch, "text", "spans") for row in passages(text, spans)), schema)

    found = marked.where("spans is not null").select("text", "spans").mapInArrow(run, "digest binary, passage string")
    return found.groupBy("digest").agg(F.min("passage").alias("least"), F.max("passage").alias("greatest")).where("least <> greatest").select("digest")


def dedup(docs, passage_words=PASSAGE_WORDS, id_col="doc_id", text_col="text"):
    """``docs`` with repeated passages removed from ``text_col``, and two more columns' stem: lines and removed lines.

    All rows and columns stay. Rows equal in id and text are one document, so none of them loses text to the
    other. Passages that a hash calls equal are compared byte by byte; should any differ, all are counted again under another
    key. NULL texts stay NULL, empty ones empty; NULL ids count as the largest. An empty table gives an empty table.
    """
    own = unused(docs.columns, "__lines")
    keyed = docs.withColumn(own, row_key(docs[f"`{id_col}`"], docs[f"`{text_col}`"]))
    found, hash_key = None, 0
    while found is None:
        ranges = repeated_ranges(bare(keyed, row_key=own, doc_id=id_col, text=text_col), passage_words, hash_key)
        marked = settle_text(keyed.join(ranges.select(F.col("row_key").alias(own), F.col("ranges").alias(f"{own}_ranges"), F.col("spans").alias(f"{own}_spans")),
                                        own, "left"), "marked")
        if unequal(bare(marked, text=text_col, spans=f"{own}_spans")).isEmpty():
            found = marked
        hash_key += 1  # different passages under one hash: all are counted again under another key
    lines = F.split(F.col(f"`{text_col}`"), "\n", -1)
    left = F.filter(lines, lambda line, i: ~F.exists(f"{own}_ranges", lambda r: (i >= r["first"]) & (i < r["past"])))
    text = F.when(F.coalesce(F.size(f"{own}_ranges"), F.lit(0)) < 1, F.col(f"`{text_col}`")).otherwise(F.array_join(left, "\n"))
    gone = F.aggregate(F.coalesce(f"{own}_ranges", F.expr("array()")), F.lit(0).cast("bigint"), lambda s, r: s + (r["past"] - r["first"]))
    columns = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return found.select(*columns, F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias(f"{own}_n"), gone.alias(f"{own}_gone")), own
