"""Films that share a genre with a planned film and open within 45 days of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmgrid.functions import dates
from filmgrid.session import written

# Fixed value: films this many days away, or more, do not compete.
WINDOW_DAYS = 45


def _bucket(day):
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / WINDOW_DAYS)


#: films of one date bucket and genre that lie together; where there are more they are dealt out over several places
CROWD = 50_000


def _places(films: DataFrame, cell: list[str], crowd: int) -> DataFrame:
    """``(*cell, _places)`` for the cells with more films than a crowd, of which there is at most one for each crowd of films."""
    counts = films.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > crowd)
    return counts.select(*cell, F.ceil(F.col("_n") / crowd).cast("int").alias("_places"))


def _met(plan: DataFrame, film: DataFrame, cell: list[str], crowd: int) -> DataFrame:
    """Plans with the films of their cells. The films of a crowded cell are dealt out, and its plans go to each place."""
    places = _places(film, cell, crowd)
    count = F.coalesce("_places", F.lit(1))
    dealt = film.join(places, cell, "left").withColumn("_place", F.pmod(F.xxhash64("movie_id"), count).cast("int")).drop("_places")
    copied = plan.join(places, cell, "left").withColumn("_place", F.explode(F.sequence(F.lit(0), count - 1))).drop("_places")
    return copied.join(dealt, [*cell, "_place"]).drop("_place")


def competitors(planned: DataFrame, films: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Every (planned film, competing film) pair, each once.

    ``planned`` has ``plan_id, plan_date, plan_genres``; an empty or null genre list means any genre. ``films`` has
    ``movie_id, release_date, genres`` and whatever else is to be shown.

    Both sides get a date bucket as wide as the window, the planned side also its two neighbours, and a genre, so the
    match is an equi-join and no row meets a film outside its neighbourhood. Plans for any genre are matched apart, by
    date alone, so films are not copied for them. A pair with several shared genres is kept only under the first of
    them, which saves a distinct over the pairs. Films are counted by bucket and genre first: a popular genre in a busy
    season is dealt out over as many places as its films need, and only its plans are copied to each.
    """
    plan = planned.withColumn("plan_genres", F.array_distinct(F.coalesce("plan_genres", F.array().cast("array<string>"))))
    centre = _bucket(F.col("plan_date"))
    plan = plan.withColumn("_bucket", F.explode(F.array(centre - 1, centre, centre + 1)))
    film = films.withColumns(
        {"_film_genres": F.array_distinct(F.coalesce("genres", F.array().cast("array<string>"))), "_bucket": _bucket(F.col("release_date"))}
    )
    # counted and matched, by bucket and by genre
    film = written(film.where("_bucket IS NOT NULL"), "competing-films")
    in_window = dates.strictly_within(F.col("release_date"), F.col("plan_date"), WINDOW_DAYS)
    open_to_all = _met(plan.where(F.size("plan_genres") == 0), film, ["_bucket"], crowd).where(in_window)
    # explode leaves out plans and films without genres
    chosen = plan.withColumn("_genre", F.explode("plan_genres"))
    shared = F.try_element_at(F.array_intersect("plan_genres", "_film_genres"), F.lit(1))
    by_genre = _met(chosen, film.withColumn("_genre", F.explode("_film_genres")), ["_bucket", "_genre"], crowd)
    by_genre = by_genre.where(in_window & (shared == F.col("_genre")))
    return by_genre.drop("_genre").unionByName(open_to_all).drop("_bucket", "_film_genres")
