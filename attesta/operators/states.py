"""Ordered folds per key: state machines, leases, budgets.

A machine's moves compose, so its fold runs over stretches of the order first and then over the
stretches of a key. A lease depends on who holds it, so its fold streams: a key's events lie in one
partition in order, and what is held of a key is its state alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def folded(events: DataFrame, key: str, order: str, state: str, allowed: dict[str, list[str]], first: str, stretch: int = 10_000) -> DataFrame:
    """key, final, rejected: the state after all allowed moves, and how many moves weren't.

    Events are gathered for each key and `stretch` of the order (distinct whole numbers, so no array
    is longer than that); each stretch gives, for every state it may be entered in, the state it ends
    in and the moves rejected; a key's stretches are then followed from the first state.
    """
    every = sorted({first, *allowed, *(t for to in allowed.values() for t in to)})
    moves = F.create_map(*(x for k, v in allowed.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    start = F.array(*(F.struct(F.lit(s).alias("now"), F.lit(0).cast("bigint").alias("rejected")) for s in every))

    def move(e: Column):
        def one(acc: Column) -> Column:
            ok = F.coalesce(F.array_contains(F.try_element_at(moves, acc.now), e), F.lit(False))
            return F.struct(F.when(ok, e).otherwise(acc.now).alias("now"), (acc.rejected + F.when(ok, 0).otherwise(1)).alias("rejected"))

        return one

    part = F.floor(F.col(order) / stretch)
    seq = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(state).alias("s")))), lambda x: x.s)
    # A stretch as a function: where it leads from each state.
    stretches = events.groupBy(key, part.alias("_part")).agg(seq.alias("seq")).select(key, "_part", F.aggregate("seq", start, lambda acc, e: F.transform(acc, move(e))).alias("to"))
    names = F.array(*map(F.lit, every))

    def follow(acc: Column, f: Column) -> Column:
        at = F.element_at(f.to, F.array_position(names, acc.now).cast("int"))
        return F.struct(at.now.alias("now"), (acc.rejected + at.rejected).alias("rejected"))

    zero = F.struct(F.lit(first).alias("now"), F.lit(0).cast("bigint").alias("rejected"))
    whole = stretches.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_part", "to"))).alias("all")).select(key, F.aggregate("all", zero, follow).alias("f"))
    return whole.select(key, F.col("f.now").alias("final"), F.col("f.rejected").alias("rejected"))


def leases(operations: DataFrame, key: str, order: str, ttl: int, now: int) -> DataFrame:
    """key, status, owner, token, rejected, expired of each job after its operations, in order.

    operations: (key, order, op, worker, at) with op claim, heartbeat, checkpoint, complete, fail or
    release, at in seconds. A claim needs a queued job or a lapsed lease, and gives the next fencing
    token; every other operation needs the lease's owner while it holds. A fail or release queues
    the job again; what is complete stays so.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        job, now_state = None, None
        blank = lambda: ["queued", None, 0, None, 0]
        shown = lambda: (job, now_state[0], now_state[1], now_state[2], now_state[4], bool(now_state[0] == "leased" and now_state[3] + ttl <= now))
        names = [key, "status", "owner", "token", "rejected", "expired"]
        for batch in batches:
            done = []
            for k, op, worker, at in zip(batch[key], batch["op"], batch["worker"], batch["at"], strict=True):
                if k != job or now_state is None:
                    if now_state is not None:
                        done.append(shown())
                    job, now_state = k, blank()
                status, owner, token, beat, rejected = now_state
                holds = status == "leased" and beat + ttl > at
                if op == "claim" and status != "complete" and not holds:
                    now_state = ["leased", worker, token + 1, at, rejected]
                elif op in ("heartbeat", "checkpoint") and holds and owner == worker:
                    now_state = ["leased", owner, token, at, rejected]
                elif op == "complete" and holds and owner == worker:
                    now_state = ["complete", owner, token, at, rejected]
                elif op in ("fail", "release") and holds and owner == worker:
                    now_state = ["queued", None, token, None, rejected]
                else:
                    now_state = [status, owner, token, beat, rejected + 1]
            yield pd.DataFrame(done, columns=names)
        if now_state is not None:
            yield pd.DataFrame([shown()], columns=names)

    kind = operations.schema[key].dataType.simpleString()
    rows = operations.select(key, order, "op", "worker", "at").repartition(key).sortWithinPartitions(key, order).drop(order)
    return rows.mapInPandas(work, f"{key} {kind}, status string, owner long, token long, rejected long, expired boolean")


def retries(events: DataFrame, key: str, order: str, ok: Column, server: Column, base: float, cap: float, budget: float) -> DataFrame:
    """Events with attempt, delay, permitted: attempts since the last success, each delayed twice as long as the one before.

    The server's own delay counts where it is longer; a run of attempts goes on while its delays,
    summed up, stay within the budget, which a success resets.
    """
    w = Window.partitionBy(key).orderBy(order)
    rows = events.withColumn("_run", F.coalesce(F.sum(ok.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    run = Window.partitionBy(key, "_run").orderBy(order)
    rows = rows.withColumn("attempt", F.row_number().over(run))
    # Beyond the 30th doubling the cap holds anyway.
    delay = F.least(F.greatest(F.lit(base) * F.pow(F.lit(2.0), F.least("attempt", F.lit(31)) - 1), F.coalesce(server, F.lit(0.0))), F.lit(cap))
    rows = rows.withColumn("delay", delay)
    return rows.withColumn("permitted", F.sum("delay").over(run.rowsBetween(Window.unboundedPreceding, 0)) <= budget).drop("_run")


def gaps(events: DataFrame, key: str, at: str, order: str) -> DataFrame:
    """Events with the seconds since the key's event before."""
    w = Window.partitionBy(key).orderBy(at, order)
    return events.withColumn("gap_s", F.unix_timestamp(at) - F.unix_timestamp(F.lag(at).over(w)))


def running(events: DataFrame, key: str, order: str, units: Column, cap: int) -> DataFrame:
    """Events with units used so far, and whether the cap still holds."""
    used = F.sum(units).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return events.withColumn("used", used).withColumn("within", F.col("used") <= cap)


def loops(events: DataFrame, key: str, order: str, cursor: Column) -> DataFrame:
    """Events whose cursor the key has seen before."""
    nth = F.row_number().over(Window.partitionBy(key, cursor).orderBy(order))
    return events.withColumn("looped", nth > 1)


def discovery(pages: DataFrame, run: str, page: str, record: str, cursor: str, most_pages: int, most_records: int) -> DataFrame:
    """run, page, new, unique, duplicates, looped, committed of each page of a run, in order of pages.

    pages: a row for each record of a page. A page is committed while no budget was spent before it
    and its cursor wasn't seen before; its records count once for the run, at their first page.
    """
    first = pages.groupBy(run, record).agg(F.min(page).alias(page)).groupBy(run, page).agg(F.count(F.lit(1)).alias("new"))
    each = pages.groupBy(run, page).agg(F.count(F.lit(1)).alias("records"), F.min(cursor).alias("_cursor")).join(first, [run, page], "left")
    order = Window.partitionBy(run).orderBy(page)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = each.withColumn("new", zero("new")).withColumn("_seen", F.row_number().over(Window.partitionBy(run, "_cursor").orderBy(page)) > 1)
    rows = rows.withColumn("_nth", F.row_number().over(order)).withColumn("_had", zero(F.sum("records").over(before))).withColumn("looped", zero(F.max(F.col("_seen").cast("int")).over(order)) == 1)
    rows = rows.withColumn("committed", (F.col("_nth") <= most_pages) & (F.col("_had") < most_records) & ~F.col("looped"))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("unique", F.sum("new").over(so_far)).withColumn("duplicates", F.sum(F.col("records") - F.col("new")).over(so_far))
    return rows.select(run, page, "new", "unique", "duplicates", "looped", "committed", "_cursor", "_nth", "_had")


def verdicts(discovered: DataFrame, run: str, page: str, most_pages: int) -> DataFrame:
    """run, pages, unique, duplicates, stop_reason, state, resume_page of each run (rows of `discovery`)."""
    c = F.col
    ends = discovered.groupBy(run).agg(
        F.max(page).alias("last"), F.max(F.when(c("committed"), c(page))).alias("at"), F.count_if("committed").alias("pages"), F.max(F.when(c("committed"), c("unique"))).alias("unique"), F.max(F.when(c("committed"), c("duplicates"))).alias("duplicates"),
        F.min(F.when(~c("committed"), F.struct(c(page).alias("p"), c("looped").alias("l")))).alias("held"),
    )
    reason = F.when(c("held").isNull(), "terminal_page").when(c("held.l"), "cursor_loop").when(c("pages") >= most_pages, "page_bound").otherwise("record_bound")
    state = F.when(reason == "terminal_page", "complete_for_observed_endpoint").when(reason == "cursor_loop", "blocked").otherwise("bounded_partial")
    return ends.select(run, "pages", "unique", "duplicates", reason.alias("stop_reason"), state.alias("state"), F.when(state == "bounded_partial", c("held.p")).alias("resume_page"))
