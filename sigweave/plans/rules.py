"""Rule chain and user-defined rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigweave.operators import keyed, lookup, stay
from sigweave.operators.lookup import Need, SharedLookups
from sigweave.operators.slices import NO_SLICES, SlicePlan, plan_slices
from sigweave.streaming.keyed import keyed_rules
from sigweave.streaming.steps import PreviousStep, StayStep, Step, TrackStep


@dataclass(frozen=True)
class RuleContext:
    """What rules may use: dimension tables, the state key and the row order."""

    dims: Mapping[str, DataFrame]
    keys: Sequence[str]
    order: Sequence[str]
    slices: SlicePlan | str = NO_SLICES
    lookups: SharedLookups | None = None

    @property
    def shared(self) -> SharedLookups:
        """The chain's look-ups; a rule that is used alone has its own."""
        return SharedLookups(self.dims) if self.lookups is None else self.lookups


class Rule(Protocol):
    """Adds label columns to rows.

    ``attach`` works on tables, and on streams if ``step`` is None. A rule that needs the
    earlier rows of a key returns its stream form from ``step``. A rule with a method ``needs``
    says what it looks up and promises to change no column that it finds; look-ups are shared
    between such rules.
    """

    name: str
    depends_on: Sequence[str]

    def attach(self, df: DataFrame, context: RuleContext) -> DataFrame: ...

    def step(self, context: RuleContext) -> Step | None: ...


@dataclass(frozen=True)
class BaseRule:
    """Common part of the rules; subclass it for a new rule."""

    name: str
    depends_on: Sequence[str] = field(default=(), kw_only=True)

    def attach(self, df: DataFrame, context: RuleContext) -> DataFrame:
        raise NotImplementedError

    def prepare(self, df: DataFrame, context: RuleContext) -> DataFrame:
        """Stateless part that goes before ``step`` in a stream."""
        return df

    def step(self, context: RuleContext) -> Step | None:
        return None


def _needs(rule: Rule) -> list[Need] | None:
    found = getattr(rule, "needs", None)
    return None if found is None else list(found())


@dataclass(frozen=True)
class AreaRule(BaseRule):
    dim: str
    on: Sequence[tuple[str, str]]
    areas: Sequence[str] = ()
    attributes: Sequence[str] = ()

    def needs(self):
        return [Need(self.dim, self.on, lookup.area_values(self.areas, self.attributes))]

    def attach(self, df, context):
        return lookup.area_labels(
            df,
            self.dim,
            self.on,
            areas=self.areas,
            attributes=self.attributes,
            shared=context.shared,
        )


@dataclass(frozen=True)
class PartyRule(BaseRule):
    dim: str
    columns: Sequence[str]
    user_key: str = "imsi"

    def needs(self):
        return _party_needs(self.dim, self.user_key, self.columns, lookup.user_parties())

    def attach(self, df, context):
        return lookup.party_labels(
            df, self.dim, self.columns, user_key=self.user_key, shared=context.shared
        )


@dataclass(frozen=True)
class TerminalRule(BaseRule):
    dim: str
    columns: Sequence[str]
    terminal_key: str = "code"

    def needs(self):
        return _party_needs(self.dim, self.terminal_key, self.columns, lookup.terminal_parties())

    def attach(self, df, context):
        return lookup.terminal_labels(
            df, self.dim, self.columns, terminal_key=self.terminal_key, shared=context.shared
        )


def _party_needs(dim: str, key: str, columns: Sequence[str], parties: lookup.Parties) -> list[Need]:
    values = lookup.party_values(columns)
    return [Need(dim, [(party, key)], values) for party in (parties.calling, parties.called)]


# Columns that a rule makes for its step on streams.
_MADE = "_text_"


@dataclass(frozen=True)
class PreviousRule(BaseRule):
    column: str = "imei"
    label: str = "last_imei"

    def needs(self):
        return []

    def attach(self, df, context):
        return keyed.previous_value(
            df,
            context.keys,
            context.order,
            self.column,
            name=self.label,
            slices=context.slices,
        )

    def prepare(self, df, context):
        # As text by Spark's rules, so that streams and tables agree.
        return df.withColumn(f"{_MADE}{self.label}", F.col(self.column).cast("string"))

    def step(self, context):
        return PreviousStep(f"{_MADE}{self.label}", self.label)


@dataclass(frozen=True)
class TrackRule(BaseRule):
    dim: str
    on: Sequence[tuple[str, str]]
    site: Sequence[str] = ("lac", "ci")

    def needs(self):
        return [Need(self.dim, self.on, lookup.position_values())]

    def prepare(self, df, context):
        if {name for name, _ in lookup.position_values()} <= set(df.columns):
            return df
        return lookup.site_position(df, self.dim, self.on, shared=context.shared)

    def attach(self, df, context):
        return keyed.user_track(
            self.prepare(df, context),
            context.keys,
            context.order,
            site=self.site,
            slices=context.slices,
        )

    def step(self, context):
        return TrackStep(context.order[0], site=tuple(self.site))


@dataclass(frozen=True)
class StayRule(BaseRule):
    areas: Sequence[str]
    limits: Sequence[int]
    timeout_ms: int = stay.DEFAULT_TIMEOUT_MS
    match_max: bool = True
    output_threshold: bool = True
    strict: bool = False

    def needs(self):
        return []

    def _options(self):
        return {
            "timeout_ms": self.timeout_ms,
            "match_max": self.match_max,
            "output_threshold": self.output_threshold,
            "strict": self.strict,
        }

    def attach(self, df, context):
        return stay.location_stay(
            df,
            context.keys,
            context.order,
            self.areas,
            self.limits,
            slices=context.slices,
            **self._options(),
        )

    def step(self, context):
        return StayStep(
            context.order[0], tuple(self.areas), tuple(self.limits), **self._options()
        )


@dataclass(frozen=True)
class FunctionRule(BaseRule):
    """Any function of a DataFrame as a rule."""

    function: Callable[[DataFrame], DataFrame]

    def attach(self, df, context):
        return self.function(df)


# Rule classes by name; a configuration refers to rules through it.
RULES: dict[str, type] = {
    "area": AreaRule,
    "party": PartyRule,
    "terminal": TerminalRule,
    "previous": PreviousRule,
    "track": TrackRule,
    "stay": StayRule,
    "function": FunctionRule,
}


def register_rule(kind: str):
    """Class decorator that makes a user's rule known under ``kind``."""

    def add(cls: type) -> type:
        if kind in RULES:
            raise ValueError(f"rule kind {kind!r} is already taken")
        RULES[kind] = cls
        return cls

    return add


def ordered_rules(rules: Sequence[Rule]) -> list[Rule]:
    """Rules in the given order, each after the rules it depends on."""
    by_name = {rule.name: rule for rule in rules}
    if len(by_name) != len(rules):
        raise ValueError("rule names must be unique")
    done: list[Rule] = []

    def visit(rule: Rule, path: tuple[str, ...]) -> None:
        if rule in done:
            return
        if rule.name in path:
            raise ValueError("rules depend on each other: " + " -> ".join([*path, rule.name]))
        for parent in rule.depends_on:
            if parent not in by_name:
                raise ValueError(f"rule {rule.name!r} depends on unknown rule {parent!r}")
            visit(by_name[parent], (*path, rule.name))
        done.append(rule)

    for rule in rules:
        visit(rule, ())
    return done


def attach_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    dims: Mapping[str, DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
    *,
    slices: SlicePlan | str | None = None,
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
) -> DataFrame:
    """Applies a rule chain to a table or a stream.

    On a table the keys are counted once for all keyed rules. On a stream, neighbouring
    keyed rules become one stateful operator; ``initial`` is the state that it starts from if
    its checkpoint is new, see ``rules_state``.
    """
    chain = ordered_rules(rules)
    lookups = SharedLookups(dims, [n for rule in chain for n in _needs(rule) or []])
    context = RuleContext(dims, keys, order, lookups=lookups)
    if df.isStreaming:
        return _attach_to_stream(df, chain, context, ttl_ms, initial)
    if slices is None and any(rule.step(context) is not None for rule in chain):
        slices = plan_slices(df, keys, order)
    context = replace(context, slices=slices or NO_SLICES)
    for rule in chain:
        df = rule.attach(_open_to(rule, df, context), context)
    return lookups.close(df)


def _open_to(rule: Rule, df: DataFrame, context: RuleContext) -> DataFrame:
    """Rows for ``rule``; one that may change any column does not see what was found."""
    return df if _needs(rule) is not None else context.shared.close(df)


def _attach_to_stream(df, chain, context, ttl_ms, initial) -> DataFrame:
    waiting: list[Step] = []
    for rule in chain:
        step = rule.step(context)
        if step is None:
            if waiting:
                df = _keyed(df, waiting, context, ttl_ms, initial)
                waiting = []
            df = rule.attach(_open_to(rule, df, context), context)
        else:
            # Stateless look-ups of a keyed rule need no state, so they may go first.
            df = rule.prepare(_open_to(rule, df, context), context)
            waiting.append(step)
    return _keyed(df, waiting, context, ttl_ms, initial) if waiting else context.shared.close(df)


def _keyed(df, steps, context, ttl_ms, initial) -> DataFrame:
    """One stateful operator for ``steps``, without the columns made for them."""
    # What was found is not sent to the state operator; later rules look up again.
    df = context.shared.close(df)
    labelled = keyed_rules(
        df, context.keys, context.order, steps, ttl_ms=ttl_ms, initial=initial
    )
    return labelled.drop(*[c for c in df.columns if c.startswith(_MADE)])


def rules_state(
    df: DataFrame,
    rules: Sequence[Rule],
    dims: Mapping[str, DataFrame],
    keys: Sequence[str],
    order: Sequence[str],
    *,
    slices: SlicePlan | str | None = None,
) -> DataFrame:
    """State of the keyed rules after all rows of a table: one row per key.

    A stream that starts from it labels later rows as if it had seen the table's rows. The
    state is worked out by the table forms, with hot keys cut into slices, and one aggregation
    by key.
    """
    chain = ordered_rules(rules)
    if slices is None:
        slices = plan_slices(df, keys, order)
    rows = attach_rules(df, rules, dims, keys, order, slices=slices)
    context = RuleContext(dims, keys, order, slices)
    state: DataFrame | None = None
    for rule in chain:
        step = rule.step(context)
        if step is None:
            continue
        marked, aggregates = step.final(rule.prepare(rows, context), keys, order, slices)
        found = marked.groupBy(*keys).agg(*aggregates)
        # All have the same keys and partitioning, so the joins exchange nothing.
        state = found if state is None else _outer(state, found, keys)
    if state is None:
        raise ValueError("no rule of the chain keeps a state")
    return state


def _outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join on ``keys`` where nulls match."""
    renamed = right.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return left.join(renamed, same, "full").select(
        *[F.coalesce(k, f"_o_{k}").alias(k) for k in keys],
        *[c for c in [*left.columns, *right.columns] if c not in keys],
    )
