"""Emotional arcs: shapes of eleven points in -1 to 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label by legs; thresholds in tenths; the threshold from which a shape is reduced; the cap of an unreliable label's confidence.
LABELS = {"u": "rags_to_riches", "d": "riches_to_rags", "du": "man_in_a_hole", "ud": "icarus", "udu": "cinderella", "dud": "oedipus"}
FIRST, LAST, REDUCED, CAP = 3, 20, 6, 0.49


def half_away(x: Column, places: int) -> Column:
    """x rounded half away from zero, and its sign kept, in binary as SQL engines do: 0.285 is 0.28, as its hundredfold is just under
    28.5. F.round goes by the shortest decimal digits and has 0.29."""
    tens = F.lit(10.0**places)
    return F.signum(x) * F.round(F.abs(x) * tens, 0) / tens


def moves(points: Column, tenths: Column) -> Column:
    """Legs as letters u and d: moves of at least the threshold from the last extreme. Differences are rounded to six places."""
    big = lambda d: F.round(d, 6) >= F.round(tenths / 10, 6)
    first = points[0]
    zero = F.struct(first.alias("lo"), first.alias("hi"), first.alias("ext"), F.lit("").alias("legs"))

    def step(s: Column, p: Column) -> Column:
        lo, hi = F.least(s["lo"], p), F.greatest(s["hi"], p)
        last = F.substring(s["legs"], -1, 1)
        none = s["legs"] == ""
        up = (none & big(p - lo)) | ((last == "d") & (p >= s["ext"]) & big(p - s["ext"]))
        down = ~up & ((none & big(hi - p)) | ((last == "u") & (p <= s["ext"]) & big(s["ext"] - p)))
        further = ((last == "u") & (p > s["ext"])) | ((last == "d") & (p < s["ext"]))
        return F.struct(lo.alias("lo"), hi.alias("hi"), F.when(up | down | further, p).otherwise(s["ext"]).alias("ext"), F.concat(s["legs"], F.when(up, "u").when(down, "d").otherwise("")).alias("legs"))

    return F.aggregate(F.slice(points, 2, F.size(points) - 1), zero, step, lambda s: s["legs"])


def derive(points: Column) -> Column:
    """Struct of label, threshold (tenths), fallback and reduced: the first threshold with one to three legs; without any, or with
    more than three at the last, the sign of the whole change decides."""
    tried = F.transform(F.sequence(F.lit(FIRST), F.lit(LAST)), lambda k: F.struct(k.alias("k"), moves(points, k).alias("legs")))
    ends = F.filter(tried, lambda x: (F.length(x["legs"]) <= 3) | (x["k"] == LAST))
    hit = F.get(ends, F.lit(0))
    good = F.length(hit["legs"]).between(1, 3)
    names = F.map_from_arrays(F.array(*map(F.lit, LABELS)), F.array(*map(F.lit, LABELS.values())))
    net = F.round(F.element_at(points, -1) - points[0], 6)
    label = F.when(good, F.try_element_at(names, hit["legs"])).otherwise(F.when(net > 0, "rags_to_riches").otherwise("riches_to_rags"))
    return F.struct(label.alias("label"), hit["k"].alias("tenths"), (~good).alias("fallback"), (hit["k"] >= REDUCED).alias("reduced"))


def confidence(stated: Column, arc: Column) -> Column:
    """The stated confidence, capped for fallback and reduced shapes."""
    return F.when(arc["fallback"] | arc["reduced"], F.least(stated, F.lit(CAP))).otherwise(stated)
