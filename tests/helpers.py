"""Small hand-built track frames."""

from __future__ import annotations

from tracklake.schemas import TRACKS


def row(sid, t, obj, *, ego=False, x=0.0, y=0.0, vx=0.0, vy=0.0, heading=0.0,
        otype="VEHICLE", length=4.5, width=2.0, valid=True):
    return (sid, t, t / 10, obj, otype, ego, float(x), float(y), float(heading),
            float(vx), float(vy), length, width, valid)


def frame(spark, rows):
    return spark.createDataFrame(rows, TRACKS)


def ego_track(sid, speeds, x_of=None):
    return [
        row(sid, t, f"{sid}_ego", ego=True, x=(x_of(t) if x_of else t), vx=v)
        for t, v in enumerate(speeds)
    ]


def pair_scene(sid, offsets, steps=None):
    """An ego at the origin for every step and one agent at the given
    (dx, dy) offsets per step (None = far away)."""
    steps = steps if steps is not None else range(len(offsets))
    rows = []
    for t in steps:
        rows.append(row(sid, t, f"{sid}_ego", ego=True, x=0.0, y=0.0))
        off = offsets[t]
        dx, dy = off if off is not None else (100.0, 100.0)
        rows.append(row(sid, t, f"{sid}_agent_00", x=dx, y=dy))
    return rows
