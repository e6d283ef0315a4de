"""Sums of doubles that do not depend on the order of the rows: exact inside, rounded once at the end.

A double is a whole number times a power of two. It is cut into ``LIMBS`` limbs of ``BITS`` bits, signed whole
numbers that any plain sum adds up exactly, in any order. A window of that many limbs holds every double whose size is
between 2^-58 and 2^53; smaller and larger ones are shifted by whole windows (``bin``) and added up apart. At the end the
limbs of all bins of a group become one number: carries are settled, and the number is rounded to the nearest double.

    rows -> (bin, limbs) -> sums by group and bin -> one row of sums per group -> double

A group and bin may hold 2^35 rows. Infinity and NaN are counted beside the limbs; with one of them the sum is theirs. All
parts are whole numbers, so what was added can be taken away again without a trace.

The expressions are SQL text: each has many terms, and building those one by one takes longer than most queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS, LIMBS = 28, 6
# A bin is shifted by 4 of the 6 limbs against the next, so that it holds all 53 bits of its doubles.
STEP = 4
# Weight of the lowest limb of bin 0 is 2^LOWEST; the sizes bin 0 takes, with a few bits to spare on both sides.
LOWEST = -STEP * BITS
SMALLEST, LARGEST = 2.0**-58, 2.0**53
BASE = 1 << BITS
#: Names of the columns of a sum: its limbs, and how many numbers are infinite (NaN counts as both infinities).
PARTS = (*[f"limb_{i}" for i in range(LIMBS)], "above", "below")
# More bits than a double has: what is cut off below them decides between neighbours only by being there or not.
ENOUGH = 1 << 2 * BITS


def _infinite(value: str) -> str:
    return f"(isnan({value}) OR abs({value}) = double('Infinity'))"


def _bin(value: str) -> str:
    """Which window a double falls into; 0 for nearly all, and for null, NaN and infinity."""
    near = f"{value} IS NULL OR {value} = 0 OR abs({value}) BETWEEN {SMALLEST!r}D AND {LARGEST!r}D OR {_infinite(value)}"
    # the logarithm may be off by one at a power of two; the window has bits to spare for that
    return f"CASE WHEN {near} THEN 0 ELSE int(floor((floor(log2(abs({value}))) + 58) / {STEP * BITS})) END"


def _shifted(value: str, bin: str) -> str:
    """The double moved into the window of its bin; null unless it is finite."""
    # two steps, since the whole shift may be beyond the range of doubles
    shift = f"power(2D, {bin} * {-STEP * BITS // 2})"
    return f"CASE WHEN NOT {_infinite(value)} THEN CASE WHEN {bin} = 0 THEN {value} ELSE {value} * {shift} * {shift} END END"


def _limb(inside: str, i: int) -> str:
    """What lies between two roundings of a shifted double to whole multiples of a power of two."""

    def rounded(limb: int) -> str:
        return f"rint({inside} * {2.0 ** -(LOWEST + BITS * limb)!r}D)"

    return f"bigint({rounded(i)} - {rounded(i + 1)} * {BASE}D)" if i + 1 < LIMBS else f"bigint({rounded(i)})"


def with_bin(rows: DataFrame, column: str) -> DataFrame:
    """The rows with the bin of a column, named ``<column>_bin``."""
    return rows.selectExpr("*", f"{_bin(column)} AS {column}_bin")


def with_parts(rows: DataFrame, column: str) -> DataFrame:
    """Rows that have the bin of a column with its parts, named ``<column>_<part>``."""
    # in two steps, so that each is a short piece of generated code; one for many columns would be too long to compile
    moved = rows.selectExpr("*", f"{_shifted(column, f'{column}_bin')} AS {column}_shifted")
    limbs = [f"{_limb(f'{column}_shifted', i)} AS {column}_limb_{i}" for i in range(LIMBS)]
    infinite = [
        f"bigint(isnan({column}) OR {column} = double('{sign}Infinity')) AS {column}_{name}" for name, sign in (("above", ""), ("below", "-"))
    ]
    return moved.selectExpr("*", *limbs, *infinite).drop(f"{column}_shifted")


def summed(column: str) -> list[Column]:
    """Aggregates that add up the parts of a column, or sums of them, in columns of the same names."""
    return [F.expr(f"sum({column}_{part}) AS {column}_{part}") for part in PARTS]


def group_sums(name: str, column: str, condition: str = "TRUE") -> list[Column]:
    """Aggregates for ``finish``: the sums of a column's bin 0 as columns, those of other bins as a list. The list has an
    entry per row of other bins, so the rows have to be sums already: some for every bin, of which there are 20."""
    near = [f"sum(CASE WHEN {condition} AND {column}_bin = 0 THEN {column}_{part} END) AS {name}_{part}" for part in PARTS]
    limbs = ", ".join(f"{column}_limb_{i}" for i in range(LIMBS))
    entry = f"named_struct('at', {column}_bin * {STEP}, 'limbs', array({limbs}))"
    # no value in another bin is infinite or not a number
    far = f"collect_list(CASE WHEN {condition} AND {column}_bin <> 0 AND {column}_limb_0 IS NOT NULL THEN {entry} END)"
    return [F.expr(x) for x in (*near, f"{far} AS {name}_far")]


def finish(rows: DataFrame, *names: str) -> DataFrame:
    """The columns of ``group_sums`` of these names made into doubles; null where there was nothing to add up."""
    usual, far = _usual_totals(rows, names), [f"size({name}_far) > 0" for name in names]
    own = [", ".join(f"coalesce({name}_limb_{i}, 0L)" for i in range(LIMBS)) for name in names]
    lists = [f"concat({name}_far, array(named_struct('at', 0, 'limbs', array({limbs}))))" for name, limbs in zip(names, own)]
    # the general way, for the rare groups that need it
    rare = _totals(usual.selectExpr("*", f"CASE WHEN {' OR '.join(far)} THEN array({', '.join(lists)}) END AS _lists"))
    inner = {f"{name}_{part}" for name in names for part in (*PARTS, "far", "digits", "high", "middle", "usual")} | set(RARE)
    done = [
        f"CASE WHEN {name}_above > 0 THEN CASE WHEN {name}_below > 0 THEN double('NaN') ELSE double('Infinity') END "
        f"WHEN {name}_below > 0 THEN double('-Infinity') "
        f"WHEN size({name}_far) > 0 THEN get(_totals, {i}) ELSE {name}_usual END AS {name}"
        for i, name in enumerate(names)
    ]
    return rare.selectExpr(*[f"`{c}`" for c in rare.columns if c not in inner], *done)


def _usual_totals(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Adds ``<name>_usual``, the double nearest to the sum of bin 0.

    The number in all its digits is up to 200 bits; the highest that fit into a decimal are enough if there
    are ``ENOUGH`` of them. Then an odd last bit stands for whatever is cut off below.
    """

    def digits(name: str) -> str:
        out, carry = [], "0L"
        for i in range(LIMBS - 1):
            here = f"({name}_limb_{i} + {carry})"
            out.append(f"'d{i}', {here} & {BASE - 1}L")
            carry = f"shiftright({here}, {BITS})"
        # the highest place keeps its sign and what it carries
        return f"named_struct({', '.join(out)}, 'top', {name}_limb_{LIMBS - 1} + {carry})"

    def joined(high: str, digits: str, one: int, two: int) -> str:
        return f"CAST(CAST({high} AS DECIMAL(38,0)) * {ENOUGH} + ({digits}.d{one} * {BASE} + {digits}.d{two}) AS DECIMAL(38,0))"

    def odd(number: str, cut: str, lowest: int) -> str:
        return f"double({number} * 2 + CASE WHEN {cut} > 0 THEN 1 ELSE 0 END) * {2.0 ** (LOWEST + BITS * lowest - 1)!r}D"

    def usual(name: str) -> str:
        d, high, middle = (f"{name}_{x}" for x in ("digits", "high", "middle"))
        return (
            f"CASE WHEN abs({high}) >= {ENOUGH} THEN {odd(high, f'{d}.d2 + {d}.d1 + {d}.d0', 3)} "
            f"WHEN abs({middle}) >= {ENOUGH} THEN {odd(middle, f'{d}.d0', 1)} "
            f"ELSE double({middle} * {BASE} + {d}.d0) * {2.0**LOWEST!r}D END"
        )

    rows = rows.selectExpr("*", *[f"{digits(name)} AS {name}_digits" for name in names])
    rows = rows.selectExpr("*", *[f"{joined(f'{name}_digits.top', f'{name}_digits', 4, 3)} AS {name}_high" for name in names])
    rows = rows.selectExpr("*", *[
        f"CASE WHEN abs({name}_high) < {ENOUGH} THEN {joined(f'{name}_high', f'{name}_digits', 2, 1)} END AS {name}_middle"
        for name in names
    ])
    return rows.selectExpr("*", *[f"{usual(name)} AS {name}_usual" for name in names])


RARE = ("_lists", "_lowest", "_dense", "_signs", "_settled", "_leading", "_totals")


def _totals(rows: DataFrame) -> DataFrame:
    """Adds ``_totals``: for each list of entries (place of the lowest limb, limbs) the double nearest to their sum."""
    ats = "transform(l, e -> e.at)"
    # room for carries above the highest limb
    places = f"sequence(array_min({ats}), array_max({ats}) + {LIMBS + 2})"
    at_place = "aggregate(l, 0L, (a, e) -> a + coalesce(get(e.limbs, p - e.at), 0L))"
    # a negative number leaves a carry of -1: its opposite is settled and rounded instead
    carry = f"aggregate(d, 0L, (c, x) -> shiftright(x + c, {BITS}))"
    here = "(x * get(_signs, i) + s.carry)"
    settle = (
        f"named_struct('carry', shiftright({here}, {BITS}), 'digits', concat(s.digits, array({here} & {BASE - 1}L)))"
    )
    # the first four digits from the highest that is not 0; whether anything but 0 is cut off; how many digits are
    begun, takes = "(s.taken > 0 OR x <> 0)", "((s.taken > 0 OR x <> 0) AND s.taken < 4)"
    lead = (
        f"named_struct('number', CASE WHEN {takes} THEN CAST(s.number * {BASE} + x AS DECIMAL(38,0)) ELSE s.number END, "
        f"'taken', s.taken + int({takes}), 'more', s.more OR ({begun} AND NOT {takes} AND x <> 0), "
        f"'below', s.below + int({begun} AND NOT {takes}))"
    )
    # an odd last digit stands for all that is cut off, far below the last bit of the double
    number = "double(s.number + CASE WHEN s.more AND s.number % 2 = 0 THEN 1 ELSE 0 END)"
    half = f"power(2D, ((get(_lowest, i) + s.below) * {BITS} + {LOWEST}) / 2)"
    steps = {
        "_lowest": f"transform(_lists, l -> array_min({ats}))",
        "_dense": f"transform(_lists, l -> transform({places}, p -> {at_place}))",
        "_signs": f"transform(_dense, d -> CASE WHEN {carry} < 0 THEN -1L ELSE 1L END)",
        "_settled": (
            "transform(_dense, (d, i) -> aggregate(d, named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)), "
            f"(s, x) -> {settle}).digits)"
        ),
        "_leading": (
            "transform(_settled, d -> aggregate(reverse(d), named_struct('number', CAST(0 AS DECIMAL(38,0)), 'taken', 0, "
            f"'more', false, 'below', 0), (s, x) -> {lead}))"
        ),
        "_totals": f"transform(_leading, (s, i) -> {number} * {half} * {half} * get(_signs, i))",
    }
    for name, step in steps.items():
        rows = rows.selectExpr("*", f"{step} AS {name}")
    return rows


def sum_by(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One row per key with the order-free sum of a column, in its name."""
    partial = with_parts(with_bin(rows, column), column).groupBy(*keys, f"{column}_bin").agg(*summed(column))
    return finish(partial.groupBy(*keys).agg(*group_sums(column, column)), column)
