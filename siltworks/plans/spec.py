"""What a refinement plan needs to know about its records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from siltworks.operators.rules import Rule, at_least


@dataclass(frozen=True)
class Spec:
    """Names and rules of one kind of record.

    A record is a struct column. It has an identifier, an array of tags (structs of
    an id and a name) that becomes a dimension and a bridge table, and a text
    attribute that becomes a dimension and is replaced by its key.
    """

    identifier: str
    tags: str
    attribute: str
    rules: Sequence[Rule]
    record: str = "value"
    tag_id: str = "id"
    tag_name: str = "name"
    bridge_key: str = "bridgeid"
    bridge_record_id: str = "recordid"
    bridge_tag_id: str = "tagid"
    attribute_key: str = "attributeid"
    attribute_name: str = "attribute"
    tables: dict[str, str] = field(
        default_factory=lambda: {
            "bronze": "record_bronze",
            "tag": "tag_silver",
            "bridge": "record_tag_silver",
            "attribute": "attribute_silver",
            "silver": "record_silver",
            "unreadable": "unreadable_documents",
        }
    )


# The movie documents, and the names and limits of the tables made of them.
MOVIE_ARRAY = "movie"
MOVIE_SCHEMA = """
    movie array<struct<
        BackdropUrl: string,
        Budget: double,
        CreatedDate: timestamp,
        Id: bigint,
        ImdbUrl: string,
        OriginalLanguage: string,
        Overview: string,
        PosterUrl: string,
        Price: double,
        ReleaseDate: timestamp,
        Revenue: double,
        RunTime: bigint,
        Tagline: string,
        Title: string,
        TmdbUrl: string,
        UpdatedBy: string,
        UpdatedDate: timestamp,
        genres: array<struct<id: bigint, name: string>>
    >>
"""
MOVIE_DATASOURCE = "trainning"
MOVIE_TABLES = {
    "bronze": "movie_bronze",
    "tag": "genre_silver",
    "bridge": "movie_genre_silver",
    "attribute": "language_silver",
    "silver": "movie_silver",
    "unreadable": "movie_unreadable",
}
MOVIE_FILES = "movie*"
PEOPLE_SCHEMA = "first string, last string, email string, phone string, address string"
PEOPLE_HEADER = ("FirstName", "LastName", "Email", "Phone", "Address")


def movie_spec(minimum_budget: float = 1000000) -> Spec:
    """The refinement of movie records: a budget floor, and no negative run time."""
    return Spec(
        identifier="Id",
        tags="genres",
        attribute="OriginalLanguage",
        rules=(
            at_least("budget", "Budget", minimum_budget, lambda c: F.lit(minimum_budget).cast("double")),
            at_least("runtime", "RunTime", 0, F.abs, null_repairable=True),
        ),
        bridge_key="moviegenreid",
        bridge_record_id="movieid",
        bridge_tag_id="genreid",
        attribute_key="languageid",
        attribute_name="language",
        tables=MOVIE_TABLES,
    )
