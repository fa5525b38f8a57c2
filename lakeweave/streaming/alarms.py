"""Alarms on silence: a rule whose results stop is pending, then firing, and resolved by its next result."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .blocks import BLOCKS, block_of

_STATE = "rule array<string>, last_ms array<bigint>, ahead_ms array<array<bigint>>, told_ms array<bigint>"
_ALARM = "rule string, state string, at_ms bigint"
PENDING, FIRING, RESOLVED = "pending", "firing", "resolved"
NEVER = 2**63 - 1
Rule = tuple[int | None, list[int], int]


class SilenceProcessor(StatefulProcessor):
    """Steps of the rules of a block, each told once the watermark has passed it, so that batches and late rows do not change them.

    The state of a rule is the last settled result and the results ahead of the watermark, of which only the first and last per
    slot of ``pending_ms`` are kept: those between them end no silence that counts. A block has one timer, for its first rule due.
    """

    def __init__(self, pending_ms: int, firing_ms: int):
        self.steps = ((pending_ms, PENDING), (firing_ms, FIRING))
        self.slot = pending_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", _STATE)

    def _load(self) -> dict[str, Rule]:
        """Per rule: last settled result, results ahead of the watermark, and the watermark up to which steps have been told."""
        if not self.seen.exists():
            return {}
        names, *columns = self.seen.get()
        return {name: (last, list(ahead), told) for name, last, ahead, told in zip(names, *columns)}

    def _wakes(self, rule: Rule) -> int:
        """The watermark beyond which the rule has something to tell: a result, or the next step of a silence."""
        last, ahead, told = rule
        due = [t - 1 for t in ahead[:1]]
        if last is not None:
            due += [last + after for after, _ in self.steps if last + after >= told]
        return min(due, default=NEVER)

    def _due(self, rules: dict[str, Rule]) -> int:
        return min(map(self._wakes, rules.values()), default=NEVER)

    def _save(self, rules: dict[str, Rule], due: int) -> None:
        self.seen.update((list(rules), *map(list, zip(*rules.values()))))
        wakes = self._due(rules)
        if wakes != due:
            if due != NEVER:
                self.handle.deleteTimer(due)
            if wakes != NEVER:
                self.handle.registerTimer(wakes)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        rules, found = self._load(), None
        due = self._due(rules)
        for frame in rows:
            slots = frame.groupby(["rule", frame["at_ms"] // self.slot])["at_ms"].agg(["min", "max"])
            found = slots if found is None else pd.concat([found, slots]).groupby(level=[0, 1]).agg({"min": "min", "max": "max"})
        new = defaultdict(set)
        for name, first, final in zip(found.index.get_level_values(0), found["min"].tolist(), found["max"].tolist()):
            new[name] |= {first, final}
        for name, times in new.items():
            last, ahead, told = rules.get(name, (None, [], 0))
            times = sorted(t for t in times.union(ahead) if last is None or t > last)
            rules[name] = (last, self._ends(times), told)
        self._save(rules, due)
        return iter(())

    def _ends(self, times: list[int]) -> list[int]:
        """First and last of each slot of ordered times."""
        slots = [t // self.slot for t in times]
        return [t for i, t in enumerate(times) if i in (0, len(times) - 1) or not slots[i - 1] == slots[i] == slots[i + 1]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rules, mark, out = self._load(), timerValues.getCurrentWatermarkInMs(), []
        for name, rule in rules.items():
            if self._wakes(rule) < mark:
                told, rules[name] = self._told(rule, mark)
                out += [(name, *step) for step in told]
        self._save(rules, NEVER)
        if out:
            names, states, times = zip(*out)
            yield pd.DataFrame({"rule": names, "state": states, "at_ms": pd.Series(times, dtype="int64")})

    def _told(self, rule: Rule, mark: int) -> tuple[list[tuple[str, int]], Rule]:
        """The steps of a rule up to the watermark, and the rule after them."""
        (last, ahead, told), out = rule, []
        while True:
            until = ahead[0] if ahead else None
            if last is not None:
                for after, name in self.steps:
                    step = last + after
                    if told <= step < mark and (until is None or step < until):
                        out.append((name, step))
            if until is None or until > mark:
                return out, (last, ahead, mark)
            if last is not None and until - last > self.slot:
                out.append((RESOLVED, until))
            last, told = ahead.pop(0), 0

    def close(self) -> None:
        pass


def silence_alarms(results: DataFrame, rule: str, time: str, pending_seconds: float, firing_seconds: float,
                   delay: str = "1 minute", blocks: int = BLOCKS) -> DataFrame:
    """Stream (rule, state, at): steps of every rule that had a result once and then none for the given spans.

    A rule is ``pending`` at last result + ``pending_seconds``, ``firing`` at + ``firing_seconds`` and ``resolved`` by the next
    result after a pending step; a result exactly on time prevents the step. Rows without rule or time are left out. Rules share
    the state of one of ``blocks``.
    """
    known = results.filter(F.col(rule).isNotNull() & F.col(time).isNotNull()).withWatermark(time, delay)
    slim = known.select(F.col(rule).cast("string").alias("rule"), F.unix_millis(F.col(time).cast("timestamp")).alias("at_ms"), time)
    steps = slim.withColumn("block", block_of("rule", blocks)).groupBy("block").transformWithStateInPandas(
        SilenceProcessor(int(pending_seconds * 1000), int(firing_seconds * 1000)), outputStructType=_ALARM, outputMode="append",
        timeMode="EventTime")
    return steps.select("rule", "state", F.timestamp_millis("at_ms").alias("at"))
