"""State machines over the history of each key, as a scan of transition maps.

An event maps every state to a state, and so does any number of events in a row.  Rows are cut
into ranges of a key (``bucket``, see ``ordered``); a pass over a range's sorted rows gives
each row the map of all events from the range's start to it, packed in one long.  Of a range
only its whole map goes on: a pass over the ranges of a key tells the state at
the start of each, which joins back.  A key may so hold any share of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.operators.ordered import bucketed

BITS = 4  # of a state in a packed map

# How the processing of a correction goes on.
CORRECTION_STATES = ["new", "validating", "validation_failed", "awaiting_second_opinion", "ready_to_finalize", "locally_finalized", "closed"]
CORRECTION_STEPS = {
    ("new", "prepare"): "validating",
    ("validating", "fail"): "validation_failed",
    ("validating", "flag"): "awaiting_second_opinion",
    ("validating", "pass"): "ready_to_finalize",
    ("validation_failed", "prepare"): "validating",
    ("awaiting_second_opinion", "decide"): "ready_to_finalize",
    ("ready_to_finalize", "finalize"): "locally_finalized",
    ("locally_finalized", "publish"): "closed",
}


class Machine:
    """States (the first is the start) and the steps between them; an event without a step leaves the state as it is."""

    def __init__(self, states: list[str], steps: dict[tuple[str, str], str]):
        if len(states) > 63 // BITS:
            raise ValueError(f"at most {63 // BITS} states")
        self.states, self.start = states, 0
        self.maps = {
            event: sum(states.index(steps.get((s, event), s)) << BITS * i for i, s in enumerate(states)) for event in sorted({e for _, e in steps})
        }
        self.allowed = {event: sum((s, event) in steps and 1 << i for i, s in enumerate(states)) for event in self.maps}
        self.same = sum(i << BITS * i for i in range(len(states)))

    def after(self, first: int, then: int) -> int:
        """The map of ``first`` and ``then`` one after the other."""
        own = [(first >> BITS * i) & ((1 << BITS) - 1) for i in range(len(self.states))]
        return sum(((then >> BITS * s) & ((1 << BITS) - 1)) << BITS * i for i, s in enumerate(own))


class Products(dict):
    """Maps of two maps, each composed once: there are few of them."""

    def __init__(self, machine: Machine):
        super().__init__()
        self.machine = machine

    def __missing__(self, pair: tuple[int, int]) -> int:
        self[pair] = value = self.machine.after(*pair)
        return value


def scanned(rows: DataFrame, group: list[str], order: list[str], own: str, machine: Machine, before: str, upto: str) -> DataFrame:
    """``rows`` with the map of all rows of their group before each (``before``), and with its own (``upto``)."""
    dealt = rows.repartition(*group).sortWithinPartitions(*group, *order)
    names, same = list(group), machine.same

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, last, now = Products(machine), None, same
        for batch in batches:
            priors, uptos = [], []
            for row in zip(*(batch[g].to_pylist() for g in names), batch[own].to_pylist(), strict=True):
                if row[:-1] != last:
                    last, now = row[:-1], same
                priors.append(now)
                now = products[now, row[-1]]
                uptos.append(now)
            yield batch.append_column(before, pa.array(priors, pa.int64())).append_column(upto, pa.array(uptos, pa.int64()))

    return dealt.mapInArrow(run, StructType(list(dealt.schema.fields)).add(before, "long").add(upto, "long"))


def shifted(bits: Column, by: Column, width: int) -> Column:
    """``width`` bits of a long from bit ``by`` on."""
    return F.call_function("shiftright", bits, by.cast("int")).bitwiseAND(F.lit((1 << width) - 1)).cast("int")


def machine_states(rows: DataFrame, key: str, *order: str, bucket: Column, event: Column, machine: Machine) -> DataFrame:
    """``rows`` with ``state_before`` and ``state`` of their key, and ``refused`` where an event has no step from there.

    A null or unknown event is refused in every state.
    """
    table = F.create_map(*(F.lit(x) for e in machine.maps for x in (e, F.struct(F.lit(machine.maps[e]).alias("to"), F.lit(machine.allowed[e]).cast("long").alias("from")))))
    step = F.when(event.isNotNull(), F.try_element_at(table, event))
    own = bucketed(rows, key, bucket).withColumn("_step", step)
    own = own.withColumn("_own", F.coalesce("_step.to", F.lit(machine.same))).withColumn("_from", F.coalesce("_step.from", F.lit(0).cast("long"))).drop("_step")
    own = scanned(own, ["_k", "_b"], list(order), "_own", machine, "_before", "_upto")
    ranges = own.groupBy("_k", "_b").agg(F.max_by("_upto", F.struct(*order)).alias("_own"))
    ranges = scanned(ranges, ["_k"], ["_b"], "_own", machine, "_prior", "_whole")
    starts = ranges.select("_k", "_b", shifted(F.col("_prior"), F.lit(machine.start * BITS), BITS).alias("_start"))

    names = F.array(*map(F.lit, machine.states))
    was, now = (shifted(F.col(c), F.col("_start") * BITS, BITS) for c in ("_before", "_upto"))
    found = own.join(starts, ["_k", "_b"]).withColumn("_was", was).withColumn("_now", now)
    return found.select(
        *rows.columns, F.get(names, "_was").alias("state_before"), F.get(names, "_now").alias("state"), (shifted(F.col("_from"), F.col("_was"), 1) == 0).alias("refused")
    )
