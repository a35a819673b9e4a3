"""Keyed stateful processors on streams: chunk broker (R10), rings (R5, R9), top-K keeper (T4), clips with their frames.

State is typed: values, lists and maps that Spark keeps in RocksDB, so the session needs that provider (rocksdb()).
Python sees one key's rows of one micro-batch at a time, and what it holds is bounded by the state, not the stream.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .clips import MEMORY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within keep their state in RocksDB, as typed state needs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _sorted_rows(batches: Iterator[pd.DataFrame], *order: str) -> list:
    frames = [b for b in batches if len(b)]
    if not frames:
        return []
    whole = frames[0] if len(frames) == 1 else pd.concat(frames)
    return list(whole.sort_values(list(order), kind="stable").itertuples(index=False))


class ChunkBroker(StatefulProcessor):
    """One action of the last chunk a step; see broker()."""

    def __init__(self, horizon: int) -> None:
        self.horizon = horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cursor = handle.getValueState("cursor", "next long, asked long, step int")
        self.chunk = handle.getListState("chunk", "action double")
        self.early = handle.getMapState("early", "t long", "reset boolean, chunk array<double>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.cursor.exists()  # a new key has no other state either, and each question costs a way to Spark and back
        due, asked, step = self.cursor.get() if known else (0, None, 0)
        chunk = [a for (a,) in self.chunk.get()] if asked is not None else []
        waiting = {t: row for (t,), row in self.early.iterator()} if known else {}
        held = set(waiting)
        for r in _sorted_rows(rows, "t"):
            if r.t >= due:
                waiting.setdefault(int(r.t), (bool(r.reset), [float(a) for a in r.chunk]))
        out, before = [], asked
        while due in waiting:
            reset, offered = waiting.pop(due)
            if reset or asked is None:
                chunk, asked, step = offered, due, 0
            out.append((key[0], due, asked, chunk[step] if step < len(chunk) else None))
            step += 1
            if step >= self.horizon:
                asked, step = None, 0
            due += 1
        for t in held - set(waiting):
            self.early.removeKey((t,))
        for t in set(waiting) - held:
            self.early.updateValue((t,), waiting[t])
        if asked is None:
            if before is not None:
                self.chunk.clear()
        elif asked != before:
            self.chunk.put([(a,) for a in chunk])
        self.cursor.update((due, asked, step))
        if out:
            yield pd.DataFrame(out, columns=["ep", "t", "asked", "action"])

    def close(self) -> None:
        pass


def broker(steps: DataFrame, horizon: int) -> DataFrame:
    """(ep, t, asked, action) for a stream of steps (ep, t, reset, chunk), t counting from 0.

    chunk is what the policy would answer if it were asked at that step. The answer to step `asked` serves that step and
    the next ones, one element each, until `horizon` of them are served; then the next step asks again. A reset clears
    what is left, so that its own step asks. An element beyond the chunk's end is null. Steps may come out of order: they
    wait in state until those before them are there. A repeated step counts once.
    """
    kind = steps.schema["ep"].dataType
    schema = StructType([StructField("ep", kind), StructField("t", LongType()), StructField("asked", LongType()), StructField("action", steps.schema["chunk"].dataType.elementType)])
    return steps.groupBy("ep").transformWithStateInPandas(ChunkBroker(horizon), schema, "append", "none")


class RingKeeper(StatefulProcessor):
    """The last values of a key; see keep_recent()."""

    def __init__(self, size: int, kind: StructField, filled: bool) -> None:
        self.size, self.kind, self.filled = size, kind, filled

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "t long")
        self.ring = handle.getListState("ring", StructType([self.kind]))
        self.early = handle.getMapState("early", "t long", StructType([self.kind]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due = self.next.get()[0] if self.next.exists() else 0
        ring = [v for (v,) in self.ring.get()] if due else []
        waiting = {t: v for (t,), (v,) in self.early.iterator()}
        held = set(waiting)
        for r in _sorted_rows(rows, "t"):
            if r.t >= due:
                waiting.setdefault(int(r.t), _plain(r.value))
        out = []
        while due in waiting:
            ring = [*ring, waiting.pop(due)][-self.size :]
            shown = [ring[0]] * (self.size - len(ring)) + ring if self.filled else ring
            out.append((key[0], due, shown))
            due += 1
        for t in held - set(waiting):
            self.early.removeKey((t,))
        for t in set(waiting) - held:
            self.early.updateValue((t,), (waiting[t],))
        if out:
            self.ring.put([(v,) for v in ring])
            self.next.update((due,))
            yield pd.DataFrame(out, columns=["ep", "t", "ring"])

    def close(self) -> None:
        pass


def keep_recent(steps: DataFrame, size: int, filled: bool = False) -> DataFrame:
    """(ep, t, ring): the last `size` values after each step of a stream (ep, t, value), t counting from 0, oldest first.

    With filled a short ring is filled up at the front with its first value. A null value has its place. Steps may come
    out of order and more than once; state holds the ring and what came early.
    """
    if size < 1:
        raise ValueError("a ring holds one value at least")
    value = StructField("value", steps.schema["value"].dataType)
    schema = StructType([StructField("ep", steps.schema["ep"].dataType), StructField("t", LongType()), StructField("ring", ArrayType(value.dataType))])
    return steps.groupBy("ep").transformWithStateInPandas(RingKeeper(size, value, filled), schema, "append", "none")


class TopKeeper(StatefulProcessor):
    """The k best of a key so far; see keep_best()."""

    def __init__(self, k: int, largest: bool) -> None:
        self.k, self.sign = k, 1 if largest else -1

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("kept", "name string", "score double, nth long")
        self.seen = handle.getValueState("seen", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n = self.seen.get()[0] if self.seen.exists() else 0
        before = {name: value for (name,), value in self.kept.iterator()}
        kept, out = dict(before), []
        for r in _sorted_rows(rows, "nth", "name"):
            score, evicted = float(r.score), None
            if len(kept) >= self.k and r.name not in kept:
                worst = min(kept, key=lambda name: (self.sign * kept[name][0], self.sign * kept[name][1]), default=None)
                if worst is None or self.sign * score <= self.sign * kept[worst][0] or score != score:
                    continue
                evicted = worst
                del kept[worst]
            kept[r.name] = (score, n)
            n += 1
            out.append((key[0], r.nth, r.name, score, evicted))
        for name in before.keys() - kept.keys():
            self.kept.removeKey((name,))
        for name, value in kept.items():
            if before.get(name) != value:
                self.kept.updateValue((name,), value)
        self.seen.update((n,))
        if out:
            yield pd.DataFrame(out, columns=["key", "nth", "name", "score", "evicted"]).astype({"evicted": object})

    def close(self) -> None:
        pass


def keep_best(offers: DataFrame, k: int, largest: bool = True) -> DataFrame:
    """T4: (key, nth, name, score, evicted) of every offer (key, nth, name, score) that is kept when it comes.

    Up to k names are held for a key. Once they are k, a new one is kept only if it is strictly better than the worst of
    them, which is then evicted (the first kept of equals; with largest=False the last). NaN is no improvement. A name
    that is held already gets its new score. k = 0 keeps none. Offers of one micro-batch are taken in the order of nth,
    micro-batches as they come.
    """
    kind = offers.schema
    schema = StructType([StructField("key", kind["key"].dataType), StructField("nth", kind["nth"].dataType), *(StructField(c, kind[c].dataType) for c in ("name", "score")), StructField("evicted", StringType())])
    return offers.groupBy("key").transformWithStateInPandas(TopKeeper(k, largest), schema, "append", "none")


class ClipCutter(StatefulProcessor):
    """Clips with their frames' columns; see cut_clips()."""

    def __init__(self, length: int, stride: int, interval: int, columns: list[StructField], patience: int, late: str) -> None:
        self.length, self.interval = length, interval
        self.reach = (length - 1) * interval + 1
        self.step = min(stride, self.reach)
        self.columns, self.patience, self.late = columns, patience, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", "ready long, clip long, size long, timer long")
        self.frames = handle.getMapState("frames", "idx long", StructType(self.columns))
        self.ended = handle.getValueState("ended", "size long, clips long", MEMORY * 1000)

    def _clip(self, key: tuple, clip: int, frames: dict[int, tuple], last: int) -> list[tuple]:
        places = [clip * self.step + j * self.interval for j in range(self.length)]
        return [(key[0], clip, j, min(at, last), at > last, None, *frames[min(at, last)]) for j, at in enumerate(places)]

    def _end(self, key: tuple, clip: int, complete: bool) -> tuple:
        return (key[0], clip, None, None, None, complete, *[None] * len(self.columns))

    def _out(self, rows: list[tuple]) -> pd.DataFrame:
        names = ["ep", "clip", "j", "idx", "is_pad", "complete", *[c.name for c in self.columns]]
        return pd.DataFrame(rows, columns=names, dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = _sorted_rows(rows, "idx")
        if self.ended.exists():
            size = self.ended.get()[0]
            beyond = [int(r.idx) for r in new if not r.is_end and r.idx >= size]
            if beyond and self.late == "error":
                raise ValueError(f"episode {key[0]} ended after {size} frames; frame {beyond[0]} came later")
            return
        open_before = self.cursor.exists()  # else there are no frames either
        ready, clip, size, timer = self.cursor.get() if open_before else (0, 0, None, None)
        held = {idx: value for (idx,), value in self.frames.iterator()} if open_before else {}
        known, out = set(held), []
        first = clip * self.step
        for r in new:
            if r.is_end:
                size = int(r.idx) if size is None else max(size, int(r.idx))
            elif r.idx >= max(ready, first):
                held.setdefault(int(r.idx), tuple(_plain(getattr(r, c.name)) for c in self.columns))
        while ready in held:
            ready += 1
        while clip * self.step + self.reach <= ready:
            out += self._clip(key, clip, held, ready - 1)
            clip += 1
        if size is not None and ready >= size:
            beyond = [i for i in held if i >= size]
            if beyond and self.late == "error":
                raise ValueError(f"episode {key[0]} ends after {size} frames, but has frame {min(beyond)}")
            if clip * self.step < size:
                out += self._clip(key, clip, held, size - 1)
                clip += 1
            out.append(self._end(key, clip, True))
            self._close(size, clip, timer, open_before)
        else:
            first = clip * self.step
            for idx in known - {i for i in held if i >= first}:
                self.frames.removeKey((idx,))
            for idx in {i for i in held if i >= first} - known:
                self.frames.updateValue((idx,), held[idx])
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + 1000 * self.patience
            self.handle.registerTimer(timer)
            self.cursor.update((ready, clip, size, timer))
        if out:
            yield self._out(out)

    def _close(self, size: int, clips: int, timer: int | None, held: bool = True) -> None:
        if held:
            self.frames.clear()
            self.cursor.clear()
        self.ended.update((size, clips))
        if timer is not None:
            self.handle.deleteTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.cursor.exists():
            ready, clip, _, _ = self.cursor.get()
            self._close(ready, clip, None)
            yield self._out([self._end(key, clip, False)])

    def close(self) -> None:
        pass


def _plain(value: object) -> object:
    """A pandas value as Python's own, NaN of a missing one as None."""
    if value is None or value is pd.NaT or isinstance(value, float) and value != value:
        return None
    return value.item() if hasattr(value, "item") and getattr(value, "shape", ()) == () else value


def cut_clips(frames: DataFrame, length: int, stride: int, interval: int, patience: int = 3600, late: str = "error") -> DataFrame:
    """Clips with their frames' own columns, as soon as the frames are there; frames: ep, idx, is_end, further columns.

    ep, clip, j, idx, is_pad, complete and the columns. An episode ends with a row of is_end, its idx the number of
    frames; frames left over then give one padded clip, and one more row has the number of clips in `clip`, no j, and
    complete = true. Without frames for `patience` seconds an episode ends as it is, complete = false.

    Frames may come out of order and more than once. State has the frames that clips to come still need; when an episode
    ends, only its length is left, for MEMORY seconds. Appending to an ended episode is an error (late="drop": ignored).
    """
    if late not in ("error", "drop"):
        raise ValueError("late is error or drop")
    own = [StructField(f.name, f.dataType) for f in frames.schema if f.name not in ("ep", "idx", "is_end")]
    schema = StructType([StructField("ep", frames.schema["ep"].dataType), *(StructField(c, LongType()) for c in ("clip", "j", "idx")), StructField("is_pad", BooleanType()), StructField("complete", BooleanType()), *own])
    return frames.groupBy("ep").transformWithStateInPandas(ClipCutter(length, stride, interval, own, patience, late), schema, "append", "processingTime")
