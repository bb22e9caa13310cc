"""Enrichment by left look-ups in dimension tables.

No broadcast is forced: Spark broadcasts a dimension when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` (at planning, or at run time under AQE) and
otherwise shuffles both sides, where AQE splits the partitions of hot keys. Rows without a
usable key meet in one partition and are split in the same way. The join columns are the keys
alone, so a later window or join on the same key needs no further exchange.

The rules of a chain share their look-ups (``SharedLookups``): what all of them want of a
dimension is one table of entries, joined once for each different key of the rows. Where rows
have several keys into one dimension, the joins have the same entries on their right side, so
Spark reads and exchanges the dimension once and uses the exchange again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigweave.functions.codes import clean_identity, device_code


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Column | str, str]],
    columns: Sequence[str],
    *,
    into: str = "_dim",
) -> DataFrame:
    """Left look-up: adds struct ``into`` with ``columns`` of ``dim``; null if not found.

    ``on`` pairs a fact expression with a dimension column. The dimension must hold one
    row per key. Facts with a null key part are kept and find nothing; like any hot key they
    are split by adaptive execution, which may split the left side of a left join.
    """
    keys = [_col(fact) for fact, _ in on]
    names = [f"_k{i}" for i in range(len(keys))]
    facts = df.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    entries = dim.select(
        *[F.col(d).alias(n) for (_, d), n in zip(on, names)],
        F.struct(*columns).alias(into),
    )
    return facts.join(entries, names, "left").drop(*names)


Keys = Sequence[tuple[Column | str, str]]
Values = Sequence[tuple[str, Column]]


@dataclass(frozen=True)
class Need:
    """Values (name and expression over the dimension) wanted for keys of the rows."""

    dim: str
    on: Keys
    values: Values


def _entries(dim: DataFrame, keys: Sequence[str], values: Values) -> DataFrame:
    # A value may have the name of a key column.
    return dim.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[v.alias(name) for name, v in values]
    )


class SharedLookups:
    """Look-ups of all rules of a chain, each made once.

    ``needs`` is everything that the rules want. What is found stays in columns of the rows
    until ``close``, so that a later rule with the same key finds it there. ``forget`` is for
    rows whose key columns may have changed.
    """

    PREFIX = "_found_"

    def __init__(self, dims: Mapping[str, DataFrame], needs: Sequence[Need] = ()):
        self._dims = dims
        self._wanted: dict[tuple, dict[str, Column]] = {}
        # Column of the rows that holds what was found, and the values in it.
        self._made: dict[tuple, tuple[str, set[str]]] = {}
        self._count = 0
        for need in needs:
            self._want(need)

    def _want(self, need: Need) -> tuple[tuple, dict[str, str]]:
        """The table of entries of a need, and under which name it has each value."""
        table = (need.dim, *[d for _, d in need.on])
        values = self._wanted.setdefault(table, {})
        names = {}
        for name, value in need.values:
            known = next((n for n, v in values.items() if repr(v) == repr(value)), None)
            if known is None:
                known = f"v{len(values)}"
                values[known] = value
            names[name] = known
        return table, names

    def find(self, df: DataFrame, need: Need) -> tuple[DataFrame, dict[str, Column]]:
        """``df`` with the found entries, and the need's values in it; null if not found."""
        table, names = self._want(need)
        place = (table, *[repr(_col(fact)) for fact, _ in need.on])
        made, held = self._made.get(place, (None, set()))
        if made not in df.columns or not set(names.values()) <= held:
            made = f"{self.PREFIX}{self._count}"
            self._count += 1
            wanted = self._wanted[table]
            entries = _entries(self._dims[need.dim], table[1:], list(wanted.items()))
            on = [(fact, f"_key_{d}") for fact, d in need.on]
            df = lookup(df, entries, on, list(wanted), into=made)
            self._made[place] = (made, set(wanted))
        return df, {name: F.col(made)[known] for name, known in names.items()}

    def forget(self) -> None:
        self._made.clear()

    def close(self, df: DataFrame) -> DataFrame:
        """``df`` without what was found."""
        self.forget()
        return df.drop(*[c for c in df.columns if c.startswith(self.PREFIX)])


def _found(
    df: DataFrame, dim: DataFrame | str, on: Keys, values: Values, shared: SharedLookups | None
) -> tuple[DataFrame, DataFrame, dict[str, Column]]:
    """Rows with their entries, the rows whose columns are to stay, and the values."""
    if shared is not None:
        found, columns = shared.find(df, Need(dim, on, values))
        return found, found, columns
    keys = [k for _, k in on]
    entries = _entries(dim, keys, values)
    names = [name for name, _ in values]
    found = lookup(df, entries, [(f, f"_key_{k}") for f, k in on], names, into="_entry")
    return found, df, {name: F.col("_entry")[name] for name in names}


def add_labels(df: DataFrame, base: DataFrame, labels: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds label columns after those of ``base``; a name the row already has wins."""
    present = set(base.columns)
    return df.select(
        *base.columns, *[value.alias(name) for name, value in labels if name not in present]
    )


def area_values(
    areas: Sequence[str] = (), attributes: Sequence[str] = (), areas_column: str = "areas"
) -> Values:
    """Flags and attributes of a site, worked out once per site, not once per row."""
    members = F.split(F.trim(F.col(areas_column)), " *, *")
    return [
        (f"area_{a}", F.when(F.array_contains(members, a), "true").otherwise("")) for a in areas
    ] + [(f"areainfo_{p}", F.col(p).cast("string")) for p in attributes]


def area_labels(
    df: DataFrame,
    sites: DataFrame | str,
    on: Keys,
    *,
    areas: Sequence[str] = (),
    attributes: Sequence[str] = (),
    areas_column: str = "areas",
    shared: SharedLookups | None = None,
) -> DataFrame:
    """Site labels: ``area_<A>`` = "true" or "", and ``areainfo_<p>`` or "".

    With ``shared`` look-ups, ``sites`` is the dimension's name.
    """
    values = area_values(areas, attributes, areas_column)
    found, base, columns = _found(df, sites, on, values, shared)
    labels = [(name, F.coalesce(value, F.lit(""))) for name, value in columns.items()]
    return add_labels(found, base, labels)


def position_values(
    longitude: str = "geo_longitude", latitude: str = "geo_latitude"
) -> Values:
    return [(c, F.col(c).cast("double")) for c in (longitude, latitude)]


def site_position(
    df: DataFrame,
    sites: DataFrame | str,
    on: Keys,
    *,
    longitude: str = "geo_longitude",
    latitude: str = "geo_latitude",
    shared: SharedLookups | None = None,
) -> DataFrame:
    """Coordinates of the row's site as doubles, 0 if the site is unknown."""
    found, base, columns = _found(df, sites, on, position_values(longitude, latitude), shared)
    labels = [(name, F.coalesce(value, F.lit(0.0))) for name, value in columns.items()]
    return add_labels(found, base, labels)


@dataclass(frozen=True)
class Parties:
    """A row's own key into a dimension and those of its two parties."""

    own: Column
    calling: Column
    called: Column


def user_parties(
    own: str = "imsi", calling: str = "callingimsi", called: str = "calledimsi"
) -> Parties:
    return Parties(F.col(own), clean_identity(calling), clean_identity(called))


def terminal_parties(
    own: str = "imei", calling: str = "callingimei", called: str = "calledimei"
) -> Parties:
    """Device type codes; none if the row's own id is too short."""
    long = F.length(own) >= 8
    return Parties(
        F.when(long, F.substring(F.col(own), 1, 8)),
        F.when(long, device_code(calling)),
        F.when(long, device_code(called)),
    )


def party_values(columns: Sequence[str]) -> Values:
    return [(c, F.col(c).cast("string")) for c in columns]


def _two_party(
    df: DataFrame,
    dim: DataFrame | str,
    dim_key: str,
    columns: Sequence[str],
    parties: Parties,
    shared: SharedLookups | None,
) -> DataFrame:
    """Labels of the two parties of a row, looked up once per side.

    With one distinct valid party the plain columns are set if it is the row's own id.
    With two, the plain columns come from the one that is the row's own id, the other one
    fills ``called_*`` or ``calling_*``.
    """
    name = dim if shared is not None else "dim"
    lookups = shared if shared is not None else SharedLookups({name: dim})
    values = party_values(columns)
    found, calling = lookups.find(df, Need(name, [(parties.calling, dim_key)], values))
    found, called = lookups.find(found, Need(name, [(parties.called, dim_key)], values))
    is_calling = F.coalesce(parties.calling == parties.own, F.lit(False))
    is_called = F.coalesce(parties.called == parties.own, F.lit(False))
    two = F.coalesce(parties.calling != parties.called, F.lit(False))

    def text(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    labels = [
        (c, F.when(is_calling, text(calling[c])).when(is_called, text(called[c])).otherwise(""))
        for c in columns
    ]
    for prefix, side, mine in (("called", called, is_called), ("calling", calling, is_calling)):
        labels += [(f"{prefix}_{c}", F.when(two & ~mine, text(side[c])).otherwise("")) for c in columns]
    return add_labels(found, df if shared is None else found, labels)


def party_labels(
    df: DataFrame,
    users: DataFrame | str,
    columns: Sequence[str],
    *,
    user_key: str = "imsi",
    own: str = "imsi",
    calling: str = "callingimsi",
    called: str = "calledimsi",
    shared: SharedLookups | None = None,
) -> DataFrame:
    """User information of the row's own user and of the other party."""
    parties = user_parties(own, calling, called)
    return _two_party(df, users, user_key, columns, parties, shared)


def terminal_labels(
    df: DataFrame,
    terminals: DataFrame | str,
    columns: Sequence[str],
    *,
    terminal_key: str = "code",
    own: str = "imei",
    calling: str = "callingimei",
    called: str = "calledimei",
    shared: SharedLookups | None = None,
) -> DataFrame:
    """Terminal information by device type code; none if the row's own id is too short."""
    parties = terminal_parties(own, calling, called)
    return _two_party(df, terminals, terminal_key, columns, parties, shared)
