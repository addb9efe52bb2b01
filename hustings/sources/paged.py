"""A paged feature service as a Spark source: a partition per page, and the box asked for pushed into the request.

`features` reads one; spark.read.format("paged_features") does after spark.dataSource.register(PagedFeatures). The rows are
page, lon, lat and member, the XML of one feature, which `readers.gml_members` takes apart.

The url has {start}, {count} and {bbox} (south, west, north, east; empty without a filter on all four sides) and may be of any kind that
urllib opens; executors ask for their own pages. Filters on lon and lat go into the box; Spark still applies them, so that a service
that ignores it changes nothing. The first page is read once, when partitions are planned, and says how many features match; without such a
number pages follow each other in one task up to the first empty one. A page beyond the last is empty. Features without a place are left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

#: Features of a page at most, and seconds to wait for one.
PER_PAGE, TIMEOUT = 5000, 120
_MEMBER = re.compile(r"<wfs:member>.*?</wfs:member>", re.S)
_MATCHED = re.compile(r'numberMatched="(\d+)"')
_PLACE = re.compile(r"<gml:pos[^>]*>\s*([-0-9.]+)\s+([-0-9.]+)\s*</gml:pos>")

Row = tuple[int, float, float, str]


class Page(InputPartition):
    """Page number, its answer where it is known, and whether the pages after it belong to it."""

    def __init__(self, number: int, answer: str | None = None, onward: bool = False):
        super().__init__(number)
        self.number, self.answer, self.onward = number, answer, onward


class PagedReader(DataSourceReader):
    def __init__(self, url: str, per_page: int):
        self.url, self.per_page = url, per_page
        self.sides: dict[tuple[str, str], float] = {}

    def _ask(self, number: int) -> str:
        sides = [self.sides.get(k) for k in (("lat", "low"), ("lon", "low"), ("lat", "high"), ("lon", "high"))]
        box = "" if None in sides else quote(",".join(map(str, sides)), safe=",")
        request = Request(self.url.format(start=number * self.per_page, count=self.per_page, bbox=box))
        with urlopen(request, timeout=TIMEOUT) as answer:
            return answer.read().decode("utf-8")

    def partitions(self) -> list[InputPartition]:
        first = self._ask(0)
        matched = _MATCHED.search(first)
        if not matched:
            return [Page(0, first, onward=True)]
        pages = max(1, math.ceil(int(matched.group(1)) / self.per_page))
        return [Page(0, first), *(Page(k) for k in range(1, pages))]

    def read(self, partition: Page) -> Iterator[Row]:
        number, answer = partition.number, partition.answer
        while True:
            members = _MEMBER.findall(self._ask(number) if answer is None else answer)
            for member in members:
                if place := _PLACE.search(member):
                    yield number, float(place.group(2)), float(place.group(1)), member
            if not members or not partition.onward:
                return
            number, answer = number + 1, None


class BoxReader(PagedReader):
    """Asks for the box that filters leave."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        for f in filters:
            column, value = ".".join(getattr(f, "attribute", ())), getattr(f, "value", None)
            if column in ("lon", "lat") and isinstance(value, (int, float)):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    self.sides[column, "low"] = max(value, self.sides.get((column, "low"), value))
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    self.sides[column, "high"] = min(value, self.sides.get((column, "high"), value))
            yield f  # a box is a hint: all filters are applied again


class PagedFeatures(DataSource):
    """Options: url; perPage, how many features a page has at most; pushBox, true to make filters the box, which takes spark.sql.python.filterPushdown.enabled."""

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return "page int, lon double, lat double, member string"

    def reader(self, schema: StructType) -> PagedReader:
        if "url" not in self.options:
            raise ValueError("paged_features needs the option url")
        reader = BoxReader if self.options.get("pushBox", "false").lower() == "true" else PagedReader
        return reader(self.options["url"], int(self.options.get("perPage", PER_PAGE)))


def features(spark: SparkSession, url: str, per_page: int = PER_PAGE) -> DataFrame:
    """page, lon, lat, member of a service; filters go into the box where the session lets Python sources have them."""
    spark.dataSource.register(PagedFeatures)
    pushed = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("paged_features").option("url", url).option("perPage", per_page).option("pushBox", pushed).load()
