"""Specs from configuration records.

A record is a dict with the columns of a configuration table; its ``properties`` are JSON
text holding lists of ``{"pname": ..., "pvalue": ...}``. Reading the records from wherever
they are kept is left to the caller.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

from sigweave.functions.times import MESSAGE_TIME_FORMAT
from sigweave.operators.parse import fields_from_json
from sigweave.operators.stay import DEFAULT_TIMEOUT_MS
from sigweave.plans.rules import (
    AreaRule,
    PartyRule,
    PreviousRule,
    Rule,
    StayRule,
    TerminalRule,
    TrackRule,
    ordered_rules,
)
from sigweave.specs import EventSpec, InterfaceSpec, SinkSpec, SourceSpec

Record = Mapping[str, str]
RuleMaker = Callable[[str, dict[str, str], list[str], Sequence[str]], Rule]

TIME_COLUMN = "time_ms"

# Functions that expression texts may call by another name; quoted parts are left alone.
_CALL = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`"""
    r"""|(?P<name>\b(?:conv|from_unixtime))\s*\(|(?P<now>\bunix_timestamp\s*\(\s*\))""",
    re.IGNORECASE,
)
_MEANT = {"conv": "hex_code(", "from_unixtime": "parse_time("}


def meant(text: str | None) -> str | None:
    """An expression text with the functions that its names stand for.

    ``conv`` of one number, ``from_unixtime`` and ``unix_timestamp()`` in milliseconds mean
    something else than the built-in functions of these names.
    """

    def put(found: re.Match) -> str:
        if found["now"]:
            return "CAST(now_ms() AS STRING)"
        return _MEANT[found["name"].lower()] if found["name"] else found[0]

    return text and _CALL.sub(put, text)


def pairs(properties: str | None, member: str | None = None) -> dict[str, str]:
    """The name-value list of a property text as a dict."""
    if not properties:
        return {}
    return {
        p["pname"]: p["pvalue"]
        for p in fields_from_json(properties, member)
        if "pname" in p and "pvalue" in p
    }


def comma_list(text: str | None) -> list[str]:
    """Items of a comma-separated text; commas inside brackets or quotes do not count."""
    items, depth, quote, current = [], 0, None, ""
    for ch in text or "":
        if quote:
            quote = None if ch == quote else quote
        elif ch in "'\"`":
            quote = ch
        elif ch in "([":
            depth += 1
        elif ch in ")]":
            depth -= 1
        if ch == "," and depth == 0 and quote is None:
            items.append(current.strip())
            current = ""
        else:
            current += ch
    items.append(current.strip())
    return [item for item in items if item]


def named(item: str) -> tuple[str, str]:
    """``expression as name`` as (expression, name); a bare column names itself."""
    found = re.fullmatch(r"(.+?)\s+as\s+(`?)(\w+)\2", item, re.IGNORECASE | re.DOTALL)
    return (found[1], found[3]) if found else (item, item)


def source_spec(datasource: Record, interface: Record) -> SourceSpec:
    """Source of an input interface."""
    store = pairs(datasource["properties"])
    props = pairs(interface["properties"], "props")
    kind = datasource["type"].lower()
    if kind == "kafka":
        direct = props.get("direct_kafka_api_flag", "true").lower() == "true"
        fetchers = props.get("num.consumer.fetchers")
        return SourceSpec(
            "kafka",
            topics=comma_list(props["topic"]),
            brokers=store["metadata.broker.list"],
            group=None if direct else props["group.id"],
            min_partitions=None if direct or not fetchers else int(fetchers),
        )
    if kind == "hdfs":
        return SourceSpec("text", path=f"{store['fs.defaultFS']}/{props['path']}")
    raise ValueError(f"source type {kind!r} is not supported")


def interface_spec(interface: Record, time_field: str = "time") -> InterfaceSpec:
    """Record layout of an input interface.

    The time of the record, in the fixed text format, becomes the column ``time_ms``.
    """
    text = interface["properties"]
    props = pairs(text, "props")
    base = fields_from_json(text, "fields")
    derived = [
        (f["pname"], meant(f["pvalue"]))
        for f in [*base, *fields_from_json(text, "userFields")]
        if f.get("pvalue", "").strip()
    ]
    stamp = f"unix_millis(try_to_timestamp(`{time_field}`, '{MESSAGE_TIME_FORMAT}'))"
    # One character stands for itself, more are a regular expression.
    delim = props.get("delim", ",")
    return InterfaceSpec(
        base,
        [k.strip() for k in props["uniqKeys"].split(":")],
        TIME_COLUMN,
        delim=delim,
        regex=len(delim) > 1,
        derived=[*derived, (TIME_COLUMN, stamp)],
        condition=meant(props.get("filter_expr", interface.get("filter_expr"))),
    )


SITE_ON = [("lac", "lac"), ("ci", "ci")]


def _after(prefix: str, items: Sequence[str]) -> list[str]:
    return [i.removeprefix(prefix) for i in items if i.startswith(prefix)]


def _area(name, props, items, parents) -> Rule:
    return AreaRule(
        name,
        "sites",
        SITE_ON,
        areas=_after("area_", items),
        attributes=_after("areainfo_", items),
        depends_on=parents,
    )


def _stay(name, props, items, parents) -> Rule:
    return StayRule(
        name,
        areas=_after("stay_", items),
        limits=[int(x) for x in comma_list(props["stay.limits"])],
        timeout_ms=int(props.get("stay.timeout", DEFAULT_TIMEOUT_MS)),
        match_max=props.get("stay.matchMax", "true").lower() == "true",
        output_threshold=props.get("stay.outputThreshold", "true").lower() == "true",
        depends_on=parents,
    )


def _party(name, props, items, parents) -> Rule:
    return PartyRule(name, "users", comma_list(props["user_info_cols"]), depends_on=parents)


def _terminal(name, props, items, parents) -> Rule:
    return TerminalRule(name, "terminals", comma_list(props["term_info_cols"]), depends_on=parents)


# Last part of a label's class name -> what builds the rule. The dimension
# tables of the pipeline are called sites, users and terminals.
MAKERS: dict[str, RuleMaker] = {
    "SiteRule": _area,
    "UserBaseInfoRule": _party,
    "TermRule": _terminal,
    "ExtLastimeiRule": lambda name, props, items, parents: PreviousRule(name, depends_on=parents),
    "LabelTrack": lambda name, props, items, parents: TrackRule(
        name, "sites", SITE_ON, depends_on=parents
    ),
    "LocationStayRule": _stay,
}


def rule_chain(
    labels: Sequence[Record], makers: Mapping[str, RuleMaker] = MAKERS
) -> list[Rule]:
    """Active rules of an interface, parents first.

    ``makers`` builds a rule for each class name, whole or its last part, from its id,
    properties, label columns and parents.
    """
    rules = []
    for label in labels:
        if str(label.get("status", "1")) != "1":
            continue
        kind = label["class_name"]
        maker = makers.get(kind) or makers.get(kind.rpartition(".")[2])
        if maker is None:
            raise ValueError(f"no rule for class {kind!r}")
        text = label.get("properties") or "{}"
        items = [
            f["pvalue"]
            for f in (fields_from_json(text, "labelItems") if text.startswith("{") else [])
        ]
        parent = (label.get("p_label_id") or "").strip()
        rules.append(
            maker(label["id"], pairs(text, "props"), items, [parent] if parent else [])
        )
    return ordered_rules(rules)


def sink_spec(datasource: Record, interface: Record, delim: str) -> SinkSpec:
    """Sink of an output interface."""
    store = pairs(datasource["properties"])
    props = pairs(interface["properties"], "props")
    kind = datasource["type"].lower()
    if kind == "kafka":
        return SinkSpec(
            "kafka", topic=props["topic"], brokers=store["metadata.broker.list"], delim=delim
        )
    if kind == "jdbc":
        return SinkSpec(
            "jdbc",
            url=store["jdbcurl"],
            table=props["tablename"],
            options={k: store[k] for k in ("user", "password") if k in store},
        )
    raise ValueError(f"sink type {kind!r} is not supported")


def event_spec(
    event: Record,
    outputs: Mapping[str, tuple[Record, Record]] | None = None,
) -> EventSpec:
    """An event; ``outputs`` gives (datasource, interface) of each output id.

    Each output has its own delimiter; the last one's interval is the event's.
    """
    text = event["properties"]
    props = pairs(text, "props")
    wanted = json.loads(text).get("output_dis", [])
    return EventSpec(
        event["id"],
        meant(event.get("filter_expr")) or "",
        [named(item) for item in comma_list(meant(event["select_expr"]))],
        ext=[named(item) for item in comma_list(meant(props.get("ext_fields")))],
        interval_s=int(wanted[-1]["interval"]) if wanted else 0,
        keep_latest=props.get("needcache") == "1",
        sinks=tuple(
            sink_spec(*outputs[out["diid"]], out.get("delim", ","))
            for out in wanted
            if outputs is not None
        ),
    )
