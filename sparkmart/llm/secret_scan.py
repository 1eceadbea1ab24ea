"""Secret scan: one minimal automaton for all rules, one pass over the bytes.

The combined automaton tells, for every byte, which rules' matches end there. A text
in which some rule's matches could be long enough is then resolved: from the first
end behind the last match, a reversed automaton of that rule finds the start and a
forward one the end of the longest match. Matches of one rule do not overlap; those
that are too short are dropped after they have used up their text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkmart.llm import automata, text_bytes


class Rule(NamedTuple):
    kind: str
    #: What a match looks like, before its final part.
    lead: str
    #: The characters of the final part, once or more.
    tail: str
    #: Characters of the final part that make a match count.
    least: int

    @property
    def pattern(self) -> str:
        return f"{self.lead}{self.tail}+"


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The kinds of the contract and what they look like.
BASE = (
    Rule(
        "assign",
        f"({_either_case('password|passwd|secret|token|api_?key')})"
        r"""["']?\x20*[:=]\x20*["']?""",
        "[A-Za-z0-9+/_.=-]",
        8,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", 12),
    Rule("hex", "", "[0-9a-f]", 32),
)
#: Further kinds, by the published formats of their issuers.
MORE = (
    Rule("github", "gh[pousr]_", "[A-Za-z0-9]", 36),
    Rule("slack", "xox[abprs]-", "[A-Za-z0-9-]", 10),
    Rule("google", "AIza", "[A-Za-z0-9_-]", 35),
    Rule("private_key", "-----BEGIN ([A-Z0-9]+ )*PRIVATE KEY", "-", 5),
)
RULES = BASE + MORE
MASK = "[SECRET]"


class _Scan:
    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        every = [r.pattern for r in rules]
        self.scanner = automata.Scanner(automata.compile_rules(every, anywhere=True))
        self.single = [
            (
                automata.compile_rules([p], anywhere=True),
                automata.compile_rules([p]),
                automata.compile_rules([p], reverse=True),
            )
            for p in every
        ]

    def candidates(
        self, block: text_bytes.Block
    ) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """For each row, the rules to resolve in it, with all runs of their ends.

        A rule is resolved in a row if one of its runs there is long enough.
        """
        if not len(block.data):
            return {}
        firsts = block.offsets[:-1][np.diff(block.offsets) > 0]
        accepts = self.scanner.accepts[self.scanner.states(block.data, firsts)]
        begins = np.zeros(len(block.data) + 1, bool)
        begins[firsts] = True
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, rule in enumerate(self.rules):
            ends = (accepts >> k & 1).astype(bool)
            starts = np.flatnonzero(ends & (begins[:-1] | ~np.append(False, ends[:-1])))
            stops = np.flatnonzero(ends & (begins[1:] | ~np.append(ends[1:], False))) + 1
            row = np.searchsorted(block.offsets, starts, "right") - 1
            for due in np.unique(row[stops - starts >= rule.least]).tolist():
                low, high = np.searchsorted(row, [due, due + 1])
                runs = np.stack([starts[low:high], stops[low:high]], 1)
                found.setdefault(due, {})[k] = (runs - block.offsets[due]).tolist()
        return found

    def matches(
        self, data: bytes, k: int, runs: list[tuple[int, int]]
    ) -> Iterator[tuple[int, int]]:
        """Leftmost, longest, non-overlapping matches of rule k that are long enough."""
        anywhere, forward, backward = self.single[k]
        last = 0
        for first, stop in runs:
            while last < stop:
                # The first end of a match that begins behind the last one.
                end = first + 1
                start = automata.leftmost_start(backward, data, end, last)
                if first < last or start < 0:
                    end = automata.first_end(anywhere, data, last, stop)
                    if end < 0:
                        break
                    start = automata.leftmost_start(backward, data, end, last)
                last = automata.longest(forward, data, start)
                if last - end + 1 >= self.rules[k].least:
                    yield start, last

    def spans(
        self, data: bytes, due: dict[int, list[tuple[int, int]]]
    ) -> list[tuple[int, int, int]]:
        """(start, rule, end) in code points, sorted."""
        found = [
            (s, k, e) for k, runs in due.items() for s, e in self.matches(data, k, runs)
        ]
        if not found:
            return []
        points = np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)
        at = np.concatenate([[0], points])
        return sorted((int(at[s]), k, int(at[e])) for s, k, e in found)


def _blocks(rules: Sequence[Rule], batches: Iterator[pa.RecordBatch]):
    """For each block: its batch, itself, and the spans of each row that has some."""
    scan = _Scan(rules)
    for batch in batches:
        for block in text_bytes.blocks(batch.column("text")):
            found = {}
            for row, due in scan.candidates(block).items():
                low, high = block.offsets[row], block.offsets[row + 1]
                found[row] = scan.spans(block.data[low:high].tobytes(), due)
            yield batch, block, found


def _finder(rules: Sequence[Rule], id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block, found in _blocks(rules, batches):
            yield pa.record_batch(
                [
                    batch.column(id_name).slice(block.first, block.rows),
                    pa.array(
                        [
                            [
                                {"kind": rules[k].kind, "start": s, "end": e}
                                for s, k, e in found.get(row, ())
                            ]
                            for row in range(block.rows)
                        ],
                        pa.list_(
                            pa.struct(
                                [
                                    ("kind", pa.string()),
                                    ("start", pa.int64()),
                                    ("end", pa.int64()),
                                ]
                            )
                        ),
                    ),
                ],
                names=[id_name, "secrets"],
            )

    return run


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, secrets) for each row of ``docs``; other columns are not read.

    ``secrets``: array of (kind, start, end), in code points, end exclusive, by start
    and then in the order of the rules. A null or empty text has none; repeated rows
    and null ids come back as often as they are there; an empty table gives none.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _finder(rules, "doc_id"),
        f"doc_id {id_type}, secrets array<struct<kind string, start long, end long>>",
    )


def _masker(rules: Sequence[Rule], mask: str, position: int, length: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block, found in _blocks(rules, batches):
            part = batch.slice(block.first, block.rows)
            if any(found.values()):
                texts = part.column(position).to_pylist()
                sizes = part.column(length).to_pylist() if length is not None else None
                for row, spans in found.items():
                    text, end = texts[row], len(texts[row] or "")
                    kept, covered = [], 0
                    for low, _, high in spans:
                        if low >= covered:
                            kept += [text[covered:low], mask]
                        covered = max(covered, high)
                    texts[row] = "".join([*kept, text[covered:end]]) if spans else text
                    if spans and sizes is not None:
                        sizes[row] = len(texts[row])
                arrays = list(part.columns)
                arrays[position] = pa.array(texts, part.schema.field(position).type)
                if sizes is not None:
                    arrays[length] = pa.array(sizes, part.schema.field(length).type)
                part = pa.RecordBatch.from_arrays(arrays, schema=part.schema)
            yield part

    return run


def mask_secrets(
    docs: DataFrame, rules: Sequence[Rule] = RULES, mask: str = MASK
) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``, all columns kept.

    ``n_chars``, if there, follows. Overlapping secrets become one mask. Rows without
    secrets, null texts and empty tables are unchanged.
    """
    names = docs.columns
    length = names.index("n_chars") if "n_chars" in names else None
    run = _masker(rules, mask, names.index("text"), length)
    return docs.mapInArrow(run, docs.schema)
