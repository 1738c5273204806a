"""Roster rules on tracks (track, team, number, conf, start, end): numbers worn twice at once, and teams that are too large.

All but the last are set-based: each decision looks at the tracks as they come in, so the order of rows doesn't matter.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import similar_numbers
from ..session import ship
from ..storage import stored
from . import joins


def valid_numbers(tracks: DataFrame, roster: DataFrame) -> DataFrame:
    """Numbers that aren't in the team's list become null. `roster`: (team, numbers array)."""
    out = tracks.join(roster, "team", "left")
    return out.withColumn("number", F.when(F.array_contains("numbers", F.col("number")), F.col("number"))).select(*tracks.columns)


def _overlapping(tracks: DataFrame, bucket: int) -> DataFrame:
    """(team, track, number, conf, o_track, o_number, o_conf): pairs of tracks of a team that share frames."""
    a = tracks.select("team", "track", "number", "conf", F.col("start").alias("s1"), F.col("end").alias("e1"))
    b = tracks.select("team", F.col("track").alias("o_track"), F.col("number").alias("o_number"), F.col("conf").alias("o_conf"), F.col("start").alias("s2"), F.col("end").alias("e2"))
    return joins.overlap(a, b, ["team"], ("s1", "e1"), ("s2", "e2"), bucket).filter("track <> o_track")


def resolve_numbers(tracks: DataFrame, roster: DataFrame, bucket: int = 1000) -> DataFrame:
    """Of tracks of a team that wear one number in the same frames the surest keeps it. The others take the first similar number of the
    roster that no track of the team wears in shared frames, or none: columns number and state (kept, changed, unsure)."""
    pairs = _overlapping(tracks, bucket)
    beaten = (F.col("o_conf") > F.col("conf")) | ((F.col("o_conf") == F.col("conf")) & (F.col("o_track") < F.col("track")))
    losers = pairs.filter((F.col("number") == F.col("o_number")) & beaten).select("team", "track", "number").distinct()
    options = losers.join(roster, "team").select("team", "track", F.posexplode(similar_numbers(F.col("number"), F.col("numbers"))).alias("pos", "option"), "number").filter("option <> number")
    worn = pairs.select("team", "track", F.col("o_number").alias("option")).distinct()
    free = options.join(worn, ["team", "track", "option"], "left_anti").groupBy("team", "track").agg(F.min(F.struct("pos", "option")).alias("f"))
    out = tracks.join(losers.select("team", "track", F.lit(True).alias("_l")), ["team", "track"], "left").join(free, ["team", "track"], "left")
    state = F.when(F.col("_l").isNull(), "kept").when(F.col("f").isNotNull(), "changed").otherwise("unsure")
    return out.withColumn("state", state).withColumn("number", F.when(F.col("_l").isNull(), F.col("number")).otherwise(F.col("f.option"))).select(*tracks.columns, "state")


def relabel_excess(tracks: DataFrame, windows: DataFrame, allowed: int, most_conf: float = 0.007, share: float = 0.1, bucket: int = 1000) -> DataFrame:
    """In windows (team, n, w_start, w_end) with more members than allowed, the n - allowed least sure tracks that are unsure enough and share
    more than `share` of their frames with the window become unsure: column relabelled."""
    hit = joins.overlap(tracks, windows, ["team"], ("start", "end"), ("w_start", "w_end"), bucket)
    hit = hit.filter((F.col("conf") <= most_conf) & ((F.col("hi") - F.col("lo") + 1) > share * (F.col("end") - F.col("start") + 1)))
    w = Window.partitionBy("team", "w_start", "w_end", "n").orderBy("conf", "track")
    gone = hit.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.col("n") - allowed).select("track").distinct()
    out = tracks.join(gone.withColumn("relabelled", F.lit(True)), "track", "left").withColumn("relabelled", F.coalesce("relabelled", F.lit(False)))
    return out.withColumn("team", F.when(F.col("relabelled"), "unsure").otherwise(F.col("team"))).select(*tracks.columns, "relabelled")


def resolve_in_frames(rows: DataFrame, roster: DataFrame, match: tuple = ()) -> DataFrame:
    """Of rows (match, frame, team, track, number, conf) that share a number in a frame the surest keeps it. The others' tracks take another
    number, one for all frames in which they wear that one: number and state (kept, changed, unsure).

    A track that has to give way somewhere, once for each number it wears, may take the similar numbers of the roster that no other track
    of the team wears in any of its frames. Tracks choose in order of confidence (the mean over the frames, then the smaller track), each
    the first of its options that no track with which it shares a frame has taken; with none left they are unsure. So no frame holds a
    number twice. A (match, team) streams through one task in that order, which holds the numbers taken in each frame, not the tracks that meet.
    """
    on, who = [*match, "frame", "team"], [*match, "team", "track", "number"]
    worn = rows.filter(F.col("number").isNotNull())
    order = Window.partitionBy(*on, "number").orderBy(F.desc("conf"), "track")
    ranked = stored(worn.select(*on, "track", "number", "conf").withColumn("_r", F.row_number().over(order)), "worn-numbers")
    lost = ranked.groupBy(*who).agg(F.max("_r").alias("_r"), F.avg("conf").alias("conf")).filter("_r > 1").drop("_r")
    lost = stored(lost.withColumn("_id", F.monotonically_increasing_id()), "giving-way")
    frames = stored(ranked.drop("_r", "conf").join(lost.drop("conf"), who), "giving-way-frames")  # the frames of those who give way
    options = lost.join(roster, "team").select(*who, "_id", F.posexplode(similar_numbers(F.col("number"), F.col("numbers"))).alias("pos", "option")).filter("option <> number")
    # a frame's numbers, of which another track wears one unless it is the only one to do so
    others = ranked.groupBy(*on, F.col("number").alias("option")).agg(F.min("track").alias("_a"), F.max("track").alias("_z"))
    taken = frames.join(others, on).filter("option <> number AND (_a <> track OR _z <> track)").select("_id", "option").distinct()
    free = options.join(taken, ["_id", "option"], "left_anti").groupBy("_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "option"))), lambda o: o["option"]).alias("options"))
    worn_in = frames.groupBy("_id").agg(F.collect_set("frame").alias("frames"))
    chosen = _chosen(lost.select(F.struct(F.lit(0), *match, "team").alias("_of"), "_id", "conf", "track").join(free, "_id").join(worn_in, "_id"))
    named = lost.drop("conf").join(chosen, "_id", "left").select(*who, F.lit(True).alias("_l"), F.col("choice").alias("_n"))
    out = rows.join(named, who, "left")
    state = F.when(F.col("_l").isNull(), "kept").when(F.col("_n").isNotNull(), "changed").otherwise("unsure")
    return out.withColumn("state", state).withColumn("number", F.when(F.col("_l").isNull(), F.col("number")).otherwise(F.col("_n"))).select(*rows.columns, "state")


def _chosen(tracks: DataFrame) -> DataFrame:
    """(_id, choice): `tracks` (_of, _id, conf, track, options, frames) of a group `_of` choose by falling confidence, then track and _id, the
    first option that none before has chosen in one of their frames. A task holds the numbers chosen in each frame of one group."""
    ship(tracks.sparkSession)

    def work(batches):
        of, taken, bits = None, {}, {}  # by frame, a bit for each number
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_key", "options", "frames"))
            out = []
            for key, options, frames in zip(*columns):
                if key != of:
                    of, taken = key, {}
                used = 0
                for f in frames:
                    used |= taken.get(f, 0)
                choice = next((o for o in options if not used & bits.setdefault(o, 1 << len(bits))), None)
                if choice is not None:
                    for f in frames:
                        taken[f] = taken.get(f, 0) | bits[choice]
                out.append(choice)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(out, pa.int32())], ["_id", "choice"])

    rows = tracks.repartition("_of").sortWithinPartitions("_of", F.desc("conf"), "track", "_id")
    return rows.select(F.to_json("_of", {"ignoreNullFields": "false"}).alias("_key"), "_id", "options", "frames").mapInArrow(work, "_id long, choice int")


class Countdown:
    """Windows [start, end] of a team with too many members, worked off in turn: the least sure members leave, which counts down the windows that
    their time covers wholly; of those that it covers in part only what lies outside stays."""

    def __init__(self, windows: list[tuple[int, int, int, frozenset]], tracks: dict[int, tuple[float, int, int]], allowed: int, most_conf: float, share: float):
        self.queue, self.tracks = list(windows), tracks
        self.allowed, self.most_conf, self.share = allowed, most_conf, share
        self.gone: set[int] = set()

    def _candidates(self, start: int, end: int, members: frozenset) -> list[tuple[float, int]]:
        out = []
        for t in members - self.gone:
            if t in self.tracks:
                conf, a, b = self.tracks[t]
                if a <= end and b >= start and (min(b, end) - max(a, start) + 1) > self.share * (b - a + 1):
                    out.append((conf, t))
        return sorted(out)

    def _cut(self, track: int) -> None:
        _, a, b = self.tracks[track]
        queue = []
        for start, end, n, members in self.queue:
            if b < start or a > end:
                queue.append((start, end, n, members))
            elif a <= start and b >= end:
                queue.append((start, end, n - 1, members - {track}))
            else:
                queue += [w for w in ((start, a - 1, n, members), (b + 1, end, n, members)) if w[0] <= w[1]]
        self.queue = queue

    def run(self) -> set[int]:
        while self.queue:
            start, end, n, members = self.queue.pop(0)
            leave = [t for conf, t in self._candidates(start, end, members)[: max(0, n - self.allowed)] if conf <= self.most_conf]
            for t in leave:
                self.gone.add(t)
                self._cut(t)
            if leave and n - len(leave) > self.allowed:
                self.queue.append((start, end, n - len(leave), members))
        return self.gone


def relabel_in_turn(tracks: DataFrame, windows: DataFrame, most_conf: float = 0.007, share: float = 0.1) -> DataFrame:
    """Relabels as relabel_excess() does, but window after window with the countdown in between: columns of `tracks` and relabelled.

    `windows`: (team, start, end, n, members array), worked off in order of start. Ten of a team are allowed, of goalkeepers and referees one. A
    team is one task: its windows and tracks, not its points.
    """
    ship(tracks.sparkSession)

    def work(batches):
        for batch in batches:
            teams, gone = [], []
            for team, t, w in zip(batch.column("team"), batch.column("_t"), batch.column("_w")):
                team = team.as_py()
                allowed = 1 if str(team).endswith("goalkeeper") or team == "referee" else 10
                queue = [(r["start"], r["end"], r["n"], frozenset(r["members"])) for r in w.as_py()]
                known = {r["track"]: (r["conf"], r["start"], r["end"]) for r in t.as_py()}
                found = sorted(Countdown(queue, known, allowed, most_conf, share).run())
                gone += found
                teams += [team] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(gone, pa.int64()), pa.array(teams, pa.string())], ["track", "team"])

    # a row a team, so that small ones go to Python by the thousand
    each = tracks.groupBy("team").agg(F.collect_list(F.struct(F.col("track").cast("long").alias("track"), F.col("conf").cast("double").alias("conf"), "start", "end")).alias("_t"))
    queues = windows.groupBy("team").agg(F.array_sort(F.collect_list(F.struct("start", "end", "n", "members"))).alias("_w"))
    gone = each.join(queues, "team").select(F.col("team").cast("string").alias("team"), "_t", "_w").mapInArrow(work, "track long, team string")
    out = tracks.join(gone.withColumn("relabelled", F.lit(True)), ["team", "track"], "left").withColumn("relabelled", F.coalesce("relabelled", F.lit(False)))
    return out.withColumn("team", F.when(F.col("relabelled") & (F.col("team") != "referee"), "unsure").otherwise(F.col("team"))).select(*tracks.columns, "relabelled")
