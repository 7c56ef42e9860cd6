"""Filling fixed-capacity containers: bounded-space best-fit packing per partition, then leftovers merged in rounds."""

from __future__ import annotations

import bisect

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.session import stage

ITEM = "array<struct<item: bigint, piece: int, start: bigint, tokens: bigint>>"
WINDOW = f"container_id string, capacity bigint, window string, used bigint, open boolean, items {ITEM}"


class OpenWindows:
    """At most ``most`` open windows of one capacity, ordered by the room left."""

    def __init__(self, capacity: int, most: int | None):
        self.capacity, self.most, self.room, self.items, self.made = capacity, most, [], {}, 0

    def put(self, size: int, items: list[tuple]):
        """Place best-fit; if no window has room and all are open, the fullest is returned, closed."""
        at, closed = bisect.bisect_left(self.room, (size, -1)), None
        if at < len(self.room):
            left, no = self.room.pop(at)
            self.items[no] += items
        else:
            if self.most is not None and len(self.room) >= self.most:
                closed = self.close(0)
            left, no = self.capacity, self.made
            self.made += 1
            self.items[no] = list(items)
        if left > size:
            bisect.insort(self.room, (left - size, no))
            return closed, None
        return closed, (no, self.capacity, self.items.pop(no))

    def close(self, at: int):
        left, no = self.room.pop(at)
        return no, self.capacity - left, self.items.pop(no)


def pack(df: DataFrame, id_col: str, size_col: str, containers: DataFrame, open_windows: int = 64, most_containers: int = 1000, merge_windows: int = 4096, full: float = 0.98, most_rounds: int = 8) -> DataFrame:
    """(container_id, window, item, piece, start, tokens): every item in windows of each container's capacity.

    Each task keeps ``open_windows`` windows a container open, puts an item where it leaves the
    least room, and closes the fullest when it fits nowhere. The windows still open at the end of a task
    (at most open_windows a container and task) are merged in rounds: they are dealt by a hash to groups of about
    ``merge_windows`` windows, and the items of a group are packed anew, largest first. Windows at least ``full`` full close; the
    rounds end when a round lowers the number of the others by less than a fiftieth, or all are in one group. So no task holds more than
    about merge_windows windows, whatever the number of tasks. An item larger than the capacity is cut into pieces of the
    capacity and a remainder, which is placed like any item; no other item is cut.

    Items with a null id are left out; a null or negative size is 0, and such items take no room: they are named in a window
    of their own, ``<task>-empty``, with no tokens. Repeated ids are items of their own. ``containers`` (container_id, capacity_tokens) is a small table:
    more than ``most_containers`` rows, or a null or non-positive capacity, raise an error.
    """
    kinds = [(r["container_id"], r["capacity_tokens"]) for r in containers.select("container_id", "capacity_tokens").distinct().limit(most_containers + 1).collect()]
    if len(kinds) > most_containers or any(k is None or c is None or c < 1 for k, c in kinds):
        raise ValueError("containers: too many, or one without a positive capacity")
    kinds.sort()

    def frame(rows):
        return pd.DataFrame(rows, columns=["container_id", "capacity", "window", "used", "open", "items"])

    def first(it):
        state = {k: OpenWindows(c, open_windows) for k, c in kinds}
        part = 0

        def row(k, w, still):
            return (k, state[k].capacity, f"{part}-{w[0]}", w[1], still, w[2])

        for pdf in it:
            if pdf.empty:
                continue
            part, out = int(pdf["part"].iloc[0]), []
            for item, size in zip(pdf["item"].tolist(), pdf["size"].tolist()):
                for k, c in kinds:
                    if not size:
                        out.append((k, c, f"{part}-empty", 0, False, [(item, 0, 0, 0)]))
                        continue
                    whole, rest = divmod(size, c)
                    s = state[k]
                    if whole and rest == 0:
                        whole, rest = whole - 1, c
                    for p in range(whole):
                        out.append((k, c, f"{part}-{s.made}", c, False, [(item, p, p * c, c)]))
                        s.made += 1
                    out += [row(k, w, False) for w in s.put(rest, [(item, whole, whole * c, rest)]) if w]
            yield frame(out)
        yield frame([row(k, s.close(0), True) for k, s in state.items() for _ in range(len(s.room))])

    def merge(no: int):
        def f(pdf: pd.DataFrame) -> pd.DataFrame:
            k, c, group = pdf["container_id"].iloc[0], int(pdf["capacity"].iloc[0]), int(pdf["_g"].iloc[0])
            items = [(i["item"], i["piece"], i["start"], i["tokens"]) for held in pdf["items"] for i in held]
            s, out = OpenWindows(c, None), []
            for i in sorted(items, key=lambda x: (-x[3], x[0], x[1])):
                out += [(w[0], w[1], False, w[2]) for w in s.put(i[3], [i]) if w]
            for _ in range(len(s.room)):
                w = s.close(0)
                out.append((w[0], w[1], w[1] < full * c, w[2]))
            return frame([(k, c, f"m{no}-{group}-{i}", used, still, held) for i, used, still, held in out])

        return f

    size = F.greatest(F.coalesce(F.col(size_col).cast("long"), F.lit(0)), F.lit(0))
    items = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("item"), size.alias("size"), F.spark_partition_id().alias("part"))
    level = stage(items.mapInPandas(first, WINDOW), "windows")
    closed = [level.where("NOT open")]
    still = {r["container_id"]: r["n"] for r in level.where("open").groupBy("container_id").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a container
    for no in range(most_rounds):
        if not still:
            break
        groups = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, n in still.items() for x in (k, -(-n // merge_windows))]), F.col("container_id")), F.lit(1))
        grouped = level.where("open").withColumn("_g", F.pmod(F.xxhash64("window", F.lit(no)), groups).cast("int"))
        level = stage(grouped.groupBy("container_id", "_g").applyInPandas(merge(no), WINDOW), "merged")
        closed.append(level.where("NOT open"))
        left = {r["container_id"]: r["n"] for r in level.where("open").groupBy("container_id").agg(F.count(F.lit(1)).alias("n")).collect()}
        done = all(n <= merge_windows for n in still.values()) or sum(left.values()) > 0.98 * sum(still.values())
        still = left
        if done:
            break
    closed.append(level.where("open"))
    out = closed[0]
    for c in closed[1:]:
        out = out.unionByName(c)
    return out.select("container_id", "window", F.explode("items").alias("i")).select("container_id", "window", "i.item", "i.piece", "i.start", "i.tokens")
