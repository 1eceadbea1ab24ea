"""Token counts by byte-pair merging with a heap and linked lists.

A text starts as one symbol per character. The adjacent pair whose joined piece
ranks best (leftmost on ties) is merged, again and again; the count is the initial
symbols minus the merges. No identifier is ever made.

No piece of the vocabulary has a space behind another character, and few characters
that are no letters stand beside a letter in any piece (both read off the vocabulary).
Where no piece can join two characters no merge crosses them, so a text is cut there:
each part is counted alone, and equal parts within a task are counted once.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How the vocabulary writes a space.
SPACE = "▁"
#: Parts whose counts a task remembers; it starts anew when they are more.
REMEMBERED = 1 << 18
#: Longer parts are counted each time.
_LONG = 64


class Vocabulary(NamedTuple):
    #: The rank of each piece that merging can make; the least is merged first.
    ranks: dict[str, int]
    #: Finds the parts of a text that no merge joins.
    parts: str


def _parts(pieces: Iterable[str]) -> str:
    """A pattern for runs of characters between which no piece reaches.

    Characters up to U+00BF that are no ASCII letters are set against all others. A
    run ends where the two kinds meet, unless at one that some piece has beside the
    other kind.
    """
    low = {chr(c) for c in range(0xC0)}
    apart = {c for c in low if not (c.isascii() and c.isalpha())}
    beside = {x for p in pieces for x in zip(p, p[1:], strict=False) if SPACE not in x}
    mixed = {c for a, b in beside if (a in apart) != (b in apart) for c in (a, b)} & apart
    v = "".join(map(re.escape, sorted(mixed)))
    q = "".join(map(re.escape, sorted(apart - mixed)))
    one = f"(?:[^{SPACE}{q}{v}]+|[{q}]+)"
    joined = f"(?:[{v}]+{one}?)"
    run = f"{one}{joined}*|{joined}+" if v else one
    return f"{SPACE}*(?:{run})|{SPACE}+" if q else f"{SPACE}*[^{SPACE}]+|{SPACE}+"


def read_vocabulary(model_file: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in scores):
        raise ValueError("the vocabulary joins words, so they can't be counted alone")
    rank = {x: i for i, x in enumerate(sorted(set(scores.values()), reverse=True))}
    return Vocabulary({p: rank[x] for p, x in scores.items()}, _parts(scores))


def count_part(part: str, ranks: dict[str, int]) -> int:
    """Tokens of one part; a character that is no piece counts as its bytes."""
    size = len(part)
    symbols: list[str] = list(part)
    initial = sum([1 if c in ranks else len(c.encode()) for c in symbols])
    if size == 1:
        return initial
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    rank_of, push, pop = ranks.get, heapq.heappush, heapq.heappop
    # An entry is one number: rank, then place of the left symbol, then joined length.
    bits = size.bit_length()
    mask = (1 << bits) - 1
    heap = [
        (rank << bits | i) << bits | 2
        for i in range(size - 1)
        if (rank := rank_of(symbols[i] + symbols[i + 1])) is not None
    ]
    heapq.heapify(heap)
    merges = 0
    while heap:
        entry = pop(heap)
        left = entry >> bits & mask
        right = after[left]
        if right == size or not symbols[left]:
            continue
        joined = symbols[left] + symbols[right]
        if len(joined) != entry & mask:
            continue  # one of the two has grown since
        symbols[left], symbols[right] = joined, ""
        merges += 1
        nearby, last = after[right], before[left]
        after[left] = nearby
        if nearby < size:
            before[nearby] = left
            longer = joined + symbols[nearby]
            if (rank := rank_of(longer)) is not None:
                push(heap, (rank << bits | left) << bits | len(longer))
        if last >= 0:
            longer = symbols[last] + joined
            if (rank := rank_of(longer)) is not None:
                push(heap, (rank << bits | last) << bits | len(longer))
    return initial - merges


class _Counts(dict):
    """Counts of parts, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.ranks = vocabulary.ranks
        self.parts = re.compile(vocabulary.parts)

    def __missing__(self, part: str) -> int:
        count = count_part(part, self.ranks)
        if len(part) <= _LONG:
            if len(self) >= REMEMBERED:
                self.clear()
            self[part] = count
        return count


def count_text(text: str, counts: _Counts) -> int:
    if not text:
        return 0
    written = SPACE + text.replace(" ", SPACE)
    return sum(map(counts.__getitem__, counts.parts.findall(written)))


def _counter(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(vocabulary)
        for batch in batches:
            tokens = [
                count_text(text.as_py() or "", counts) for text in batch.column("text")
            ]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    pa.array(tokens, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``docs`` has doc_id and text; other columns are not read. Whole texts are
    counted, without begin, end or special tokens, and without truncation; the
    strings of special tokens are ordinary text.

    * a null or empty text has no bytes and no tokens;
    * repeated rows and null ids are returned as often as they come;
    * an empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
    ).mapInArrow(
        _counter(read_vocabulary(model_file)),
        f"doc_id {id_type}, n_bytes long, n_tokens long",
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
