"""Operator 10, secret scans: all rules in one byte pass of a combined deterministic automaton.

A match of a rule is a head followed by a run of bytes of one class. Heads with the first byte of their run are compiled
together by subset construction and minimisation (`automaton`); one pass over the bytes of a task's texts tells which
rules' heads end where. An automaton of the reversed heads leads from there back to the starts, and the run's length
to the end: long counts are kept as run lengths, since each would multiply the states of a combined automaton. Rows are
independent: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checkmart.llm.automaton import Automaton, Backward, compile_backward, compile_rules, scan, starts_of
from checkmart.llm.words import chunks


class Rule(NamedTuple):
    """A match is `head` and then the longest run of bytes in the class `run` (no run where that is empty).

    A shorter run than `need` is no match. A match whose run is shorter than `least` is taken and dropped: what it covers
    is not searched again. `counted` bytes of the run are left to the automaton, which then sees fewer ends.
    """

    kind: str
    head: str
    run: str = ""
    need: int = 1
    least: int = 1
    counted: int = 1
    fold_case: bool = False

    @property
    def search(self) -> str:
        """What the automaton looks for: the head and the first bytes of the run."""
        return f"{self.head}{self.run}{{{self.counted}}}" if self.run else self.head


# The rules' expressions.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        "[A-Za-z0-9+/_.=-]",
        least=8,
        fold_case=True,
    ),
    Rule("access", "AKIA", "[A-Z0-9]", least=12),
    Rule("hex", "", "[0-9a-f]", need=32, least=32, counted=32),
)
ADDED = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.", "[A-Za-z0-9_-]", need=8, least=8),
    Rule("host_token", "gh[pousr]_", "[A-Za-z0-9]", need=36, least=36),
    Rule("chat_token", "xox[abprs]-", "[A-Za-z0-9-]", need=10, least=10),
)
RULES = BASE + ADDED


def _run_table(rule: Rule) -> np.ndarray:
    """Which bytes belong to the rule's runs."""
    one = compile_rules([(rule.run, rule.fold_case)])
    return one.accepts[one.steps[one.classes]] != 0


def _matches(
    rules: tuple[Rule, ...],
    tables: list[np.ndarray | None],
    backward: Backward,
    data: np.ndarray,
    positions: np.ndarray,
    masks: np.ndarray,
) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes: leftmost, then longest, matches that do not overlap others of their rule."""
    found = []
    for k, (rule, table) in enumerate(zip(rules, tables, strict=True)):
        hits = np.sort(positions[masks >> k & 1 == 1])
        if table is None:
            heads, runs = hits + 1, np.zeros(len(hits), np.int64)
        else:
            heads = hits - (rule.counted - 1)
            if not rule.head:  # one run is one match
                heads = heads[np.diff(heads, prepend=-2) > 1]
            outside = np.flatnonzero(~table[data]) if len(heads) else heads
            runs = np.append(outside, len(data))[np.searchsorted(outside, heads)] - heads
            heads, runs = heads[runs >= rule.need], runs[runs >= rule.need]
        numbers, starts = starts_of(backward, data, heads, np.full(len(heads), k))
        ends = (heads + runs)[numbers]
        order = np.lexsort((-ends, starts))
        kept = runs[numbers] >= (rule.least if rule.run else 0)
        after = 0
        for start, end, stays in zip(starts[order].tolist(), ends[order].tolist(), kept[order].tolist(), strict=True):
            if start >= after:
                after = end
                if stays:
                    found.append((start, k, end))
    return sorted(found)


def _scan_rows(rules: tuple[Rule, ...], automaton: Automaton, backward: Backward, tables: list[np.ndarray | None]):
    separator = int(np.flatnonzero(automaton.resets)[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch["__text"].cast(pa.binary()).to_pylist()]
            found: list[list[dict]] = [[] for _ in texts]
            for part in chunks(texts, 1 << 22):
                data = np.frombuffer(bytes([separator]).join(texts[part]) + bytes([separator]), np.uint8)
                spans = _matches(rules, tables, backward, data, *scan(automaton, data))
                if not spans:
                    continue
                ends = np.cumsum([len(t) + 1 for t in texts[part]])
                own = np.searchsorted(ends, [start for start, _, _ in spans], side="right")
                begins = np.append(0, ends)[own]
                inner = np.flatnonzero(data & 0xC0 == 0x80)  # bytes that begin no code point
                edges = np.array([(start, end) for start, _, end in spans])
                edges -= np.searchsorted(inner, edges) + (begins - np.searchsorted(inner, begins))[:, None]
                for text, (_, k, _), (start, end) in zip(own.tolist(), spans, edges.tolist(), strict=True):
                    found[part.start + text].append({"kind": rules[k].kind, "start": start, "end": end})
            others = [n for n in batch.schema.names if n != "__text"]
            spans = pa.array(
                found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            )
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in others), spans], names=[*others, "spans"])

    return run


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(doc_id, spans) for every row: spans (kind, start, end) by start, then by the order of the rules.

    Null and empty texts have no spans. Spans of different kinds may overlap. Rows without id and repeated rows are rows
    like any other; further columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    automaton = compile_rules([(r.search, r.fold_case) for r in rules])
    backward = compile_backward([(r.head, r.fold_case) for r in rules])
    tables = [_run_table(r) if r.run else None for r in rules]
    return rows.mapInArrow(
        _scan_rows(rules, automaton, backward, tables), f"doc_id {id_type}, spans array<struct<kind: string, start: int, end: int>>"
    )
