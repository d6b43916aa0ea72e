"""Map tags to crop classes, and the query text that fetches them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is asked of the map service.
SELECTORS = (
    'way["landuse"="vineyard"]',
    'relation["landuse"="vineyard"]',
    'way["landuse"="orchard"]',
    'relation["landuse"="orchard"]',
    'way["landuse"="residential"]',
    'relation["landuse"="residential"]',
    'way["natural"="water"]',
    'relation["natural"="water"]',
    'way["landuse"="reservoir"]',
    'way["highway"~"motorway|trunk|primary|secondary"]',
)


def tag_class(tags: Column) -> Column:
    """Fixed priority: vineyard, orchard, residential or reservoir, water, any highway; else NULL."""
    tag = lambda k: F.try_element_at(tags, F.lit(k))
    other = tag("landuse").isin("residential", "reservoir") | (tag("natural") == "water") | (F.length(tag("highway")) > 0)
    return F.when(tag("landuse") == "vineyard", "vineyard").when(tag("landuse") == "orchard", "orchard").when(other, "non_agri")


def selected(kind: Column, tags: Column) -> Column:
    """Whether an element (way or relation) meets any selector."""
    out = F.lit(False)
    for selector in SELECTORS:
        element, key, sign, value = re.fullmatch(r'(\w+)\["(\w+)"([=~])"(.+)"\]', selector).groups()
        tag = F.try_element_at(tags, F.lit(key))
        out = out | ((kind == element) & F.coalesce(tag == value if sign == "=" else tag.rlike(value), F.lit(False)))
    return out


def overpass_query(west: Column, south: Column, east: Column, north: Column, timeout: int = 180) -> Column:
    """One query text with all selectors; the service wants south, west, north, east."""
    box = F.concat_ws(",", *[x.cast("string") for x in (south, west, north, east)])
    parts = [F.concat(F.lit(selector + "("), box, F.lit(");")) for selector in SELECTORS]
    return F.concat(F.lit(f"[out:json][timeout:{timeout}];("), *parts, F.lit(");out geom;"))
