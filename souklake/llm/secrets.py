"""Secret scans: fixed patterns, and strings that a public vocabulary can only spell in short tokens.

The base finds assigned passwords and keys, access key ids and long hexadecimal strings. The method looks at
the long runs of key characters that remain: natural language, names and paths fall into tokens of several
characters, random strings do not. Runs with few characters per token are secrets, whatever their alphabet.

Left out of the count are digests (of the usual lengths), UUIDs, and numbers and times between separators; a run
that consists of these and of separators by more than a third is an identifier, and so is a short piece repeated
all over. Random keys are hardly ever of these forms. Capitals may be spelled in lower case, as constants are.
Where a path or an address as a whole is no secret, its parts between slashes are looked at.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souklake.llm.common import ship, whole

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How a text is cut before its pieces are spelled in tokens; only key characters come here.
PIECES = r"[A-Za-z]+|[0-9]{1,3}|[^A-Za-z0-9]+"

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

# Runs that may be keys, how long they must be, and the largest ratio of characters to tokens of a random one.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
MAX_RATIO = 2.1
MIN_RUN = 20
DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
DIGEST_SIZES = frozenset((32, 40, 48, 56, 64, 96, 128))
UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\Z")
PIECE = re.compile(r"[A-Za-z0-9]+")
NUMBER = re.compile(r"[0-9]*(?:T[0-9]+)?Z?\Z")
REPEATED = re.compile(r"(.{1,5}?)\1{3,}.{0,4}\Z")
_SCHEMA = "n_assign long, n_access long, n_hex long, spans array<struct<kind:string,start:int,end:int>>"


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file, read where the driver runs; executors get its bytes with the task."""
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=2)
def encoding(ranks: bytes) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("secrets", pat_str=PIECES, mergeable_ranks=table, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns: leftmost matches of each kind, failing ones left out."""
    spans = []
    if "=" in text or ":" in text:
        lowered = text.lower()
        if any(word in lowered for word in ASSIGN_WORDS):
            spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    if any(len(word) >= MIN_HEX for word in text.split()):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return spans


def _spelled(run: str, vocabulary: tiktoken.Encoding) -> tuple[int, int]:
    """Characters and tokens of a run, without separators, digests, UUIDs and numbers."""
    chars = tokens = 0
    for part in run.split("/"):
        if UUID.match(part) or DIGEST.match(part) and len(part) in DIGEST_SIZES:
            continue
        for piece in PIECE.findall(part):
            if not NUMBER.match(piece):
                chars += len(piece)
                spellings = {piece, piece.lower()} if piece.isupper() else {piece}
                tokens += min(len(vocabulary.encode_ordinary(spelling)) for spelling in spellings)
    return chars, tokens


def is_random(run: str, vocabulary: tiktoken.Encoding, max_ratio: float = MAX_RATIO) -> bool:
    if REPEATED.match(run):
        return False
    chars, tokens = _spelled(run, vocabulary)
    return 3 * chars >= 2 * len(run) and chars <= max_ratio * tokens


def random_parts(run: str, vocabulary: tiktoken.Encoding) -> list[tuple[int, int]]:
    """(start, end) of what is random in a run: all of it, or else stretches of its parts between slashes.

    A key may contain slashes itself, so neighbouring parts are joined as long as their tokens outweigh words.
    """
    lead = len(run) - len(run.lstrip("/")) if run.startswith("//") else 0
    if len(run) - lead >= MIN_RUN and is_random(run[lead:], vocabulary):
        return [(lead, len(run))]
    if "/" not in run:
        return []
    parts, weights, found, at = [], [], [], 0
    for part in run.split("/"):
        chars, tokens = _spelled(part, vocabulary)
        parts.append((at, at + len(part)))
        weights.append(MAX_RATIO * tokens - chars if chars else -len(part))
        at += len(part) + 1

    def check(first: int, last: int) -> bool:
        start, end = parts[first][0], parts[last][1]
        if end - start < MIN_RUN or not is_random(run[start:end], vocabulary):
            return False
        found.append((start, end))
        return True

    first = 0
    while first < len(parts):
        total, best, last = 0.0, 0.0, -1
        for i in range(first, len(parts)):
            total += weights[i]
            if total > best:
                best, last = total, i
            if total < 0:
                break
        if last < 0:
            first += 1
            continue
        if not check(first, last):
            for i in range(first, last + 1):
                check(i, i)
        first = last + 1
    return found


def find_spans(text: str, vocabulary: tiktoken.Encoding) -> list[tuple[int, int, int]]:
    """All spans of a text, by start and then by kind; added ones never overlap those of the base."""
    spans = base_spans(text)
    if any(len(word) >= MIN_RUN for word in text.split()):
        taken = sorted((start, end) for start, _, end in spans)
        for m in RUN.finditer(text):
            if not any(start < m.end() and m.start() < end for start, end in taken):
                spans += [(m.start() + start, 3, m.start() + end) for start, end in random_parts(m[0], vocabulary)]
    return sorted(spans)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, spans (kind, start, end in code points) per row of ``docs``.

    A null text counts as empty. Repeated rows give repeated results; an empty table gives no rows; other
    columns are ignored. Texts are handled one by one, so memory is bounded by a batch and the longest text.
    """
    ship(docs.sparkSession)
    ranks = read_vocabulary(vocabulary)
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoding(ranks)
        span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            counts, found = ([], [], []), []
            for body in batch.column(1):
                spans = find_spans(body.as_py(), words)
                for kind in range(3):
                    counts[kind].append(sum(span[1] == kind for span in spans))
                found.append([{"kind": KINDS[kind], "start": start, "end": end} for start, kind, end in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(found, span_type)],
                names=["doc_id", "n_assign", "n_access", "n_hex", "spans"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, {_SCHEMA}")


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask``; null texts stay null."""
    ship(docs.sparkSession)
    ranks = read_vocabulary(vocabulary)

    @F.udf("string", useArrow=True)
    def masked(body: str | None) -> str | None:
        if body is None:
            return None
        out, at = [], 0
        for start, _, end in find_spans(body, encoding(ranks)):
            if start >= at:
                out += [body[at:start], mask]
            at = max(at, end)
        return "".join(out) + body[at:]

    return docs.withColumn(text, masked(F.col(text)))
