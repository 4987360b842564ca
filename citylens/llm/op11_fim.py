"""Fill-in-the-middle transformation by secondary-sort assembly.

A document of n units (code points) is cut into prefix, middle and suffix and
written in another order, each part behind its sentinel: ``psm`` (prefix,
suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (unchanged).
The cuts and the form come from a digest of the document's id.

Method.  Every document is emitted as pieces of at most ``chunk`` units, keyed
by (document, output position).  ``repartitionAndSortWithinPartitions`` on the
document brings the pieces of a document into one partition in output order,
where they stream into an incremental digest; no task ever holds a whole
output.  The same stream is parsed back: sentinels are searched across the
borders of pieces, and the parts go on as pieces keyed by (document, original
position).  The second ``repartitionAndSortWithinPartitions`` has the
partitioner of the first, so it sorts again in place (Spark's external sorter,
which spills) without moving anything, and streams into the second digest.

Scale.  One shuffle of the texts, deflated piece by piece, into partitions of
``PARTITION_BYTES``; documents are dealt by a hash of their number, so one hot source or a group of copies spreads; a
very long text travels as many pieces and is never put together.

Input.  ``docs`` must be a table (or another input that a repeated task reads
in the same order), as rows are told apart by partition and position.

Defined results.  NULL text: as empty.  Empty text, or a text that holds a
sentinel: ``plain``.  NULL id: digests use the empty text as id.  Repeated rows
and ids: one result each.  Empty table: no rows.  Other columns of the input
are not looked at, so their names cannot clash.  There are no ties: positions
of a document are unique.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentinels, shares of the forms in per cent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Sentinels of a form in output order, each with the rank of its part in the original text.
ORDER = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
#: Units in a piece.
CHUNK = 65_536
PARTITION_BYTES = 64_000_000
_DEFLATE_FROM = 160

RESULT = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, "
          "output_sha256 string, restored_sha256 string")


def layout(doc_id: int | None, text: str) -> tuple[str, int, int]:
    """Form and the two cuts of a document."""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return "plain", first, second
    return "spm" if h4 % 100 < SPM_BELOW else "psm", first, second


def _packed(piece: str) -> tuple[bool, bytes]:
    raw = piece.encode()
    return (True, zlib.compress(raw, 1)) if len(raw) >= _DEFLATE_FROM else (False, raw)


def _unpacked(piece: tuple[bool, bytes]) -> bytes:
    return zlib.decompress(piece[1]) if piece[0] else piece[1]


def _pieces(rows: Iterator, index: int, chunk: int) -> Iterator:
    """((document, output position), piece); position 0 is the document's header."""
    for nth, (doc_id, text) in enumerate(rows):
        text = text or ""
        document = index << 40 | nth
        form, first, second = layout(doc_id, text)
        plain = form == "plain"
        yield (document, 0), (doc_id, len(text), form, None if plain else first, None if plain else second - first)
        bounds = {0: (0, first), 1: (first, second), 2: (second, len(text))}
        parts = [("", 0, len(text))] if plain else [(s, *bounds[rank]) for s, rank in ORDER[form]]
        at = 0
        for sentinel, start, end in parts:
            for cut in range(start, max(end, start + 1), chunk):
                piece = sentinel + text[cut:min(cut + chunk, end)]
                if piece:
                    at += 1
                    yield (document, at), _packed(piece)
                sentinel = ""


class Parser:
    """Splits the pieces of an output at the sentinels of its form, in order.

    The text holds no sentinel, so the next one found is the next one written;
    two bytes are held back, as a sentinel may be cut by the border of pieces.
    """

    def __init__(self, form: str):
        self.left = [(s.encode(), rank) for s, rank in ORDER.get(form, ())]
        self.rank, self.held = 0, b""

    def feed(self, piece: bytes) -> Iterator[tuple[int, bytes]]:
        self.held += piece
        while self.left:
            at = self.held.find(self.left[0][0])
            if at < 0:
                ready, self.held = self.held[:-2], self.held[-2:]
                if ready:
                    yield self.rank, ready
                return
            if at:
                yield self.rank, self.held[:at]
            self.held, self.rank = self.held[at + 3:], self.left.pop(0)[1]
        if self.held:
            yield self.rank, self.held
            self.held = b""


def _output_digests(pieces: Iterator) -> Iterator:
    """Sorted output pieces -> parts keyed by original position, and the header with the output's digest."""
    header = document = digest = parser = None
    at = 0
    for (of, position), piece in pieces:
        if position == 0:
            if header is not None:
                yield (document, -1, 0), (*header, digest.hexdigest())
            header, document, at, digest, parser = piece, of, 0, hashlib.sha256(), Parser(piece[2])
            continue
        raw = _unpacked(piece)
        digest.update(raw)
        for rank, part in parser.feed(raw):
            at += 1
            yield (document, rank, at), ((True, zlib.compress(part, 1)) if len(part) >= _DEFLATE_FROM else (False, part))
    if header is not None:
        yield (document, -1, 0), (*header, digest.hexdigest())


def _restored_digests(pieces: Iterator) -> Iterator:
    header = digest = None
    for (_, rank, _), piece in pieces:
        if rank < 0:
            if header is not None:
                yield (*header, digest.hexdigest())
            header, digest = piece, hashlib.sha256()
        else:
            digest.update(_unpacked(piece))
    if header is not None:
        yield (*header, digest.hexdigest())


def _by_document(key: tuple) -> int:
    return zlib.crc32(key[0].to_bytes(8, "little"))


def _partitions(docs: DataFrame, text_col: str) -> int:
    """As many that a partition holds ``PARTITION_BYTES`` of text, and no fewer than Spark's setting."""
    n_bytes, = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0))).first()
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_bytes // PARTITION_BYTES)


def sorted_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> RDD:
    """((document, output position), piece) in output order, all of a document in one partition."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).rdd
    return rows.mapPartitionsWithIndex(lambda index, it: _pieces(it, index, chunk)) \
        .repartitionAndSortWithinPartitions(_partitions(docs, text_col), _by_document)


def output_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The transformed documents as pieces: ``document`` (a number per row), ``doc_id``, ``form``, ``position``
    (1, 2, ...), ``piece``; a document's pieces stand in order in one partition.  An empty text has no piece."""

    def written(pieces):
        header = None
        for (document, position), piece in pieces:
            if position == 0:
                header = piece
            else:
                yield document, header[0], header[2], position, _unpacked(piece).decode()

    return docs.sparkSession.createDataFrame(sorted_pieces(docs, id_col, text_col, chunk).mapPartitions(written),
                                             "document long, doc_id long, form string, position long, piece string")


def restore(outputs: DataFrame, text_col: str = "text", form_col: str = "form") -> DataFrame:
    """Whole transformed texts -> the original texts in ``text_col``, from output and form alone."""

    def original(batches):
        for batch in batches:
            texts = []
            for text, form in zip(batch[text_col], batch[form_col]):
                if text is not None:
                    parser = Parser(form)
                    parts = sorted(parser.feed(text.encode()), key=lambda part: part[0])
                    text = b"".join(part for _, part in parts).decode()
                texts.append(text)
            batch[text_col] = texts
            yield batch

    return outputs.mapInPandas(original, outputs.schema)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row per document: form, cuts, digest of the output and digest of the text rebuilt from it."""
    parts = sorted_pieces(docs, id_col, text_col, chunk).mapPartitions(_output_digests, preservesPartitioning=True)
    resorted = parts.repartitionAndSortWithinPartitions(parts.getNumPartitions(), _by_document)
    return docs.sparkSession.createDataFrame(resorted.mapPartitions(_restored_digests), RESULT)
