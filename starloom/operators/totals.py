"""Totals that do not depend on the order in which rows arrive.

A sum of doubles changes in its last digits with the order of its input, and with it the
ranks made from it, so a retried task could give another report. Amounts are summed here as
the decimal numbers they stand for (the shortest decimal that gives the double), in whole
numbers.

The decimal positions are divided into bins of eight: bin b holds the digits from 10^8b on.
An amount of at most 17 digits touches three bins in a row; it is filed under the lowest
and gives each of them a whole number below 10^8. Rows are first totalled by group and bin,
three sums of longs, then a group's few bins are put together. Amounts of any size take part,
as bins are made where amounts need them: money, up to eight decimals and 10^16, fills one.

A group's total is the double nearest to the exact sum where its bins span 38 digits at
most, else the sum of its bins' doubles from the smallest up: the same bits for any order
and any partitions. NaN and infinities are counted in a bin of their own. A bin takes 9e10
rows of a group; beyond them the sum of longs stops the job, it does not go wrong.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = 100_000_000
_WIDTH = 8
# the bin of NaN, infinity and negative infinity, counted in its three sums
_SPECIAL = 1000


@dataclass(frozen=True)
class Weighted:
    """Sum of the amounts, each as often as its whole weight says."""

    amount: str
    weight: str


def _digits(name: str, amount: str) -> list[str]:
    """Columns that take a double apart: sign, lowest bin, and what it adds to three bins.

    Up to six decimals, as money has them, need no text.
    """
    size, millionths, plain = f"abs({amount})", f"{name}_millionths", f"{name}_plain"
    text, whole, power, bin_ = (f"{name}_{part}" for part in ("text", "whole", "power", "bin"))
    scaled, units, rest = f"{name}_scaled", f"{name}_units", f"{name}_rest"
    number = f"substring_index({text}, 'E', 1)"
    return [
        f"case when {size} < 9e9 then floor({size} * 1e6 + 0.5) end as {millionths}",
        f"coalesce({millionths} / 1e6 = {size}, false) as {plain}",
        f"case when not {plain} and {size} < double('Infinity') then cast({size} as string) end as {text}",
        f"cast(replace({number}, '.', '') as bigint) as {whole}",
        f"case when contains({text}, 'E') then cast(substring_index({text}, 'E', -1) as int) else 0 end"
        f" - length(substring_index({number}, '.', -1)) as {power}",
        f"case when {plain} then -1 when {text} is not null then cast(floor({power} / {_WIDTH}) as int)"
        f" when {amount} is not null then {_SPECIAL} end as {bin_}",
        f"case when {text} is not null then element_at(array(1L, 10L, 100L, 1000L, 10000L, 100000L,"
        f" 1000000L, 10000000L), {power} - {_WIDTH} * {bin_} + 1) end as {scaled}",
        f"case when {plain} then {millionths} % 1000000 * 100"
        f" else {whole} % {_BASE} * {scaled} end as {units}",
        f"case when {plain} then {millionths} div 1000000"
        f" else {whole} div {_BASE} * {scaled} + {units} div {_BASE} end as {rest}",
        f"case when {amount} < 0 then -1L else 1L end as {name}_sign",
    ]


def _parts(name: str, amount: str) -> list[str]:
    """What the amount adds to its bin and the next two; the special bin counts its kinds."""
    special, sign = f"{name}_bin = {_SPECIAL}", f"{name}_sign"
    units, rest = f"{name}_units", f"{name}_rest"
    return [
        f"case when {special} then cast(isnan({amount}) as bigint)"
        f" else {sign} * ({units} % {_BASE}) end as {name}_low",
        f"case when {special} then cast({amount} = double('Infinity') as bigint)"
        f" else {sign} * ({rest} % {_BASE}) end as {name}_mid",
        f"case when {special} then cast({amount} = double('-Infinity') as bigint)"
        f" else {sign} * ({rest} div {_BASE}) end as {name}_high",
    ]


def _entry(output: str, bin_: str, parts: Sequence[str]) -> str:
    low, mid, high = parts
    return (
        f"named_struct('output', '{output}', 'bin', {bin_}, 'low', {low}, 'mid', {mid}, 'high', {high})"
    )


def _weighted_entries(output: str, name: str) -> list[str]:
    """The products of the amount's parts and the weight's, each in the bins it falls into."""
    kinds = [f"{name}_{kind}" for kind in ("low", "mid", "high")]
    special = [f"case when {name}_bin = {_SPECIAL} then {kind} end" for kind in kinds]
    entries = [_entry(output, f"case when {name}_bin = {_SPECIAL} then {_SPECIAL} end", special)]
    for i, kind in enumerate(kinds):
        for j in range(3):
            product = f"{kind} * {name}_weight{j}"
            # zeros are left out, but for one, which tells that there is an amount
            some = "" if i + j == 0 else f" and {kind} != 0 and {name}_weight{j} != 0"
            bin_ = (
                f"case when {name}_bin < {_SPECIAL} and {name}_weight0 is not null{some}"
                f" then {name}_bin + {i + j} end"
            )
            entries.append(_entry(output, bin_, [f"{product} % {_BASE}", f"{product} div {_BASE}", "0L"]))
    return entries


def _weight_digits(name: str, weight: str) -> list[str]:
    return [
        f"{weight} % {_BASE} as {name}_weight0",
        f"{weight} div {_BASE} % {_BASE} as {name}_weight1",
        f"{weight} div {_BASE**2} as {name}_weight2",
    ]


def _bin_total(part: str) -> str:
    return (
        f"(cast({part}.low as decimal(20,0)) + cast({part}.mid as decimal(20,0)) * {_BASE}BD"
        f" + cast({part}.high as decimal(20,0)) * {_BASE**2}BD)"
    )


def _as_double(total: str, bin_: str) -> str:
    # parsing rounds to the nearest double, whatever the power
    return f"cast(concat(cast({total} as string), 'E', cast({_WIDTH} * ({bin_}) as string)) as double)"


def _value(parts: str) -> str:
    """The double of a group's bins."""
    least = f"array_min(transform({parts}, p -> p.bin))"
    shift = f"element_at(array(1BD, {_BASE}BD, {_BASE**2}BD, {_BASE**3}BD), p.bin - {least} + 1)"
    exact = (
        f"case when array_max(transform({parts}, p -> p.bin)) - {least} < 4 then aggregate({parts},"
        f" cast(0 as decimal(38,0)), (a, p) -> cast(try_add(a, cast(try_multiply("
        f"{_bin_total('p')}, cast({shift} as decimal(38,0))) as decimal(38,0))) as decimal(38,0))) end"
    )
    ordered = (
        f"aggregate(array_sort({parts}), 0D, (a, p) -> a + {_as_double(_bin_total('p'), 'p.bin')})"
    )
    special = f"element_at(filter({parts}, p -> p.bin = {_SPECIAL}), 1)"
    first = f"{parts}[0]"
    return (
        f"case when size({parts}) = 0 then null"
        f" when size({parts}) = 1 and {first}.bin < {_SPECIAL}"
        f" then {_as_double(_bin_total(first), f'{first}.bin')}"
        f" when exists({parts}, p -> p.bin = {_SPECIAL}) then case"
        f" when {special}.low > 0 or ({special}.mid > 0 and {special}.high > 0) then double('NaN')"
        f" when {special}.mid > 0 then double('Infinity') else double('-Infinity') end"
        f" else coalesce({_as_double(exact, least)}, {ordered}) end"
    )


def exact_totals(
    rows: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, str | Weighted],
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Totals by group: exact sums of doubles, and sums of whole numbers beside them.

    `sums` names an expression for each output, or an amount with its weight; `counts`
    expressions of whole numbers (`1` counts rows). Nulls are skipped; a sum without any
    amount is null, and so is a weighted one where amount or weight is missing. Without
    groups the result is one row.
    """
    counts = counts or {}
    columns = [*by, *[f"cast({e} as bigint) as {output}" for output, e in counts.items()]]
    kept, entries = [*by, *counts], []
    for k, (output, s) in enumerate(sums.items()):
        name, amount = f"sum{k}", s
        if isinstance(s, Weighted):
            # an infinity takes the sign of its weight; zero times it is no number
            special = f"isnan({s.amount}) or abs({s.amount}) = double('Infinity')"
            amount = f"case when {special} then {s.amount} * {s.weight} else {s.amount} end"
            columns += _weight_digits(name, f"cast({s.weight} as bigint)")
            kept += [f"{name}_weight{j}" for j in range(3)]
            entries += _weighted_entries(output, name)
        else:
            kinds = [f"{name}_{kind}" for kind in ("low", "mid", "high")]
            entries.append(_entry(output, f"{name}_bin", kinds))
        columns.append(f"cast({amount} as double) as {name}")
        kept += [f"{name}_bin", *_parts(name, name)]
    digits = [column for k in range(len(sums)) for column in _digits(f"sum{k}", f"sum{k}")]
    rows = rows.selectExpr(*columns).selectExpr("*", *digits).selectExpr(*kept)
    names = [*by, *counts]
    several = len(entries) > 1
    if several:
        # the whole numbers go with one more entry, which has no bin
        none = _entry("", "cast(null as int)", ["0L"] * 3)
        rows = (
            rows.selectExpr(
                *by,
                *[f"{name} as all_{name}" for name in counts],
                f"inline(array({', '.join([*entries, none])}))",
            )
            .where("bin is not null or output = ''")
            .selectExpr(
                *by,
                *[f"case when output = '' then all_{name} end as {name}" for name in counts],
                "output",
                "bin",
                "low",
                "mid",
                "high",
            )
        )
    else:
        parts = [f"sum0_{part} as {part}" for part in ("bin", "low", "mid", "high")]
        rows = rows.selectExpr(*names, *parts)
    binned = rows.groupBy(*by, *(["output"] if several else []), "bin").agg(
        F.sum("low").alias("low"),
        F.sum("mid").alias("mid"),
        F.sum("high").alias("high"),
        *[F.sum(name).alias(name) for name in counts],
    )

    def bins(output: str):
        own = f"output = '{output}' and " if several else ""
        return F.expr(
            f"collect_list(case when {own}bin is not null"
            " then named_struct('bin', bin, 'low', low, 'mid', mid, 'high', high) end)"
        )

    put = binned.groupBy(*by).agg(
        *[bins(output).alias(f"bins_{output}") for output in sums],
        *[F.sum(name).alias(name) for name in counts],
    )
    return put.selectExpr(*by, *[f"{_value(f'bins_{output}')} as {output}" for output in sums], *counts)
