"""Contact lists: normalise, merge and de-duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions.text import ADDRESS_MARKS, lowered, plain_address, without_dashes
from siltworks.operators.distinct import distinct_union
from siltworks.plans.spec import PEOPLE_HEADER


def normalize_people(people: DataFrame, marks: str = ADDRESS_MARKS) -> DataFrame:
    """The five contact fields in comparable form, named as in the output header."""
    first, last, email, phone, address = (F.col(name) for name in people.columns)
    fields = (
        lowered(first),
        lowered(last),
        lowered(email),
        without_dashes(phone),
        plain_address(address, marks),
    )
    return people.select(*[f.alias(name) for f, name in zip(fields, PEOPLE_HEADER)])


def merged_people(*lists: DataFrame, marks: str = ADDRESS_MARKS) -> DataFrame:
    """Distinct normalised contacts of all lists."""
    return distinct_union(*[normalize_people(people, marks) for people in lists])
