"""Registration of queries with their oracle SQL, and what all of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

EV = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts)/1e6 AS t FROM events)"
PT = "p AS (SELECT vec_id, label, embedding[1]::DOUBLE*100 AS x, embedding[2]::DOUBLE*100 AS y, embedding[3]::DOUBLE*100 AS z FROM embeddings)"
#: Points with the attributes of a scan, and the frames of a camera (every 25th point) with their poses.
PTS = PT + """, pt AS (SELECT vec_id AS id, x, y, z, label AS cls, vec_id*0.37::DOUBLE AS gps, vec_id%7 AS psid, (vec_id*37)%256 AS r, (vec_id*73)%256 AS g, (vec_id*151)%256 AS b, 1+vec_id%3 AS nret, (vec_id*977)%65536 AS intensity, CAST(floor(x/20)+10 AS BIGINT)*100+CAST(floor(y/20)+10 AS BIGINT) AS tile FROM p)"""
FRS = PTS + """, fr AS (SELECT id//25 AS frame, gps AS t, x AS e, y AS n, z+2 AS h, (id*13)%360-180.0::DOUBLE AS yaw, (id%7)-3.0::DOUBLE AS roll, (id%5)-2.0::DOUBLE AS pitch, cls AS pass_id FROM pt WHERE id%25=0)"""
W = "OVER (PARTITION BY user_id ORDER BY t, event_id)"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def r(c, digits: int = 4):
    """Rounded, and never minus zero: independent of the order of sums."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + 0.0


def as_sql(c, digits: int):
    """Rounded like ``r``, but as the SQL does: scaled first, so that what then lies halfway goes away from zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c * 10.0**digits) / 10.0**digits + 0.0
