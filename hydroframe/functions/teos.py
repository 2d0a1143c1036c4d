"""TEOS-10 seawater: conservative temperature, specific volume and its derivatives, height, gravity, N squared.

Conservative temperature is potential enthalpy over its constant heat capacity; potential temperature is found from entropy
by two steps of a modified Newton method.  Specific volume is the polynomial of 75 terms of Roquet et al. (2015) in the root
of salinity, temperature and pressure; density, expansion and contraction are that polynomial and its derivatives.  Sound
speed is that of the Gibbs function.

Polynomials of three variables are nested Column expressions by Horner's rule; the same rule writes them as SQL text.
Salinity is absolute (g/kg; below zero counts as zero), temperatures are in degrees, pressure is in dbar.  Null gives null.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of TEOS-10: heat capacity, standard salinity, scale of salinity, its offset in the specific volume.
CP0, SSO, SFAC, OFFSET = 3991.86795711963, 35.16504, 0.0248826675584615, 0.5971840214030754
#: Scales of temperature and pressure; gravity's rise with depth; surface gravity by latitude.
Y, Z, GAMMA, GRAVITY = 0.025, 1e-4, 2.26e-7, (9.780327, 5.2792e-3, 2.32e-5)

#: Fixed values of the specific volume (m3/kg): rows by power of the salinity root and of temperature, along pressure.
VOLUME = {
    (0, 0): (1.0769995862e-3, -6.0799143809e-5, 9.9856169219e-6, -1.1309361437e-6, 1.0531153080e-7, -1.2647261286e-8, 1.9613503930e-9),
    (0, 1): (-1.5649734675e-5, 1.8505765429e-5, -1.1736386731e-6, -3.6527006553e-7, 3.1454099902e-7),
    (0, 2): (2.7762106484e-5, -1.1716606853e-5, 2.1305028740e-6, 2.8695905159e-7),
    (0, 3): (-1.6521159259e-5, 7.9279656173e-6, -4.6132540037e-7),
    (0, 4): (6.9111322702e-6, -3.4102187482e-6, -6.3352916514e-8),
    (0, 5): (-8.0539615540e-7, 5.0736766814e-7),
    (0, 6): (2.0543094268e-7,),
    (1, 0): (-3.1038981976e-4, 2.4262468747e-5, -5.8484432984e-7, 3.6310188515e-7, -1.1147125423e-7),
    (1, 1): (3.5009599764e-5, -9.5677088156e-6, -5.5699154557e-6, -2.7295696237e-7),
    (1, 2): (-3.7435842344e-5, -2.3678308361e-7, 3.9137387080e-7),
    (1, 3): (2.4141479483e-5, -3.4558773655e-6, 7.7618888092e-9),
    (1, 4): (-8.7595873154e-6, 1.2956717783e-6),
    (1, 5): (-3.3052758900e-7,),
    (2, 0): (6.6928067038e-4, -3.4792460974e-5, -4.8122251597e-6, 1.6746303780e-8),
    (2, 1): (-4.3592678561e-5, 1.1100834765e-5, 5.4620748834e-6),
    (2, 2): (3.5907822760e-5, 2.9283346295e-6, -6.5731104067e-7),
    (2, 3): (-1.4353633048e-5, 3.1655306078e-7),
    (2, 4): (4.3703680598e-6,),
    (3, 0): (-8.5047933937e-4, 3.7470777305e-5, 4.9263106998e-6),
    (3, 1): (3.4532461828e-5, -9.8447117844e-6, -1.3544185627e-6),
    (3, 2): (-1.8698584187e-5, -4.8826139200e-7),
    (3, 3): (2.2863324556e-6,),
    (4, 0): (5.8086069943e-4, -1.7322218612e-5, -1.7811974727e-6),
    (4, 1): (-1.1959409788e-5, 2.5909225260e-6),
    (4, 2): (3.8595339244e-6,),
    (5, 0): (-2.1092370507e-4, 3.0927427253e-6),
    (5, 1): (1.3864594581e-6,),
    (6, 0): (3.1932457305e-5,),
}
#: Fixed values of potential enthalpy (J/kg): rows by power of the salinity root, along temperature.
ENTHALPY = {
    0: (61.01362420681071, 168776.46138048015, -2735.2785605119625, 2574.2164453821433, -1536.6644434977543, 545.7340497931629, -50.91091728474331, -18.30489878927802),
    2: (268.5520265845071, -12019.028203559312, 3734.858026725145, -2046.7671145057618, 465.28655623826234, -0.6370820302376359, -10.650848542359153),
    3: (937.2099110620707, 588.1802812170108, 248.39476522971285, -3.871557904936333, -2.6268019854268356),
    4: (-1687.914374187449, 936.3206544460336, -942.7827304544439, 369.4389437509002, -33.83664947895248, -9.987880382780322),
    5: (246.9598888781377,),
    6: (123.59576582457964,),
    7: (-48.5891069025409,),
}
#: Fixed values of entropy without its salinity part (J/kg/K, times -40): rows by power of the salinity root and of temperature, along pressure.
ENTROPY = {
    (0, 0): (0.0, -270.983805184062, 776.153611613101, -196.51255088122, 28.9796526294175, -2.13290083518327),
    (0, 1): (-24715.571866078, 2910.0729080936, -1513.116771538718, 546.959324647056, -111.1208127634436, 8.68841343834394),
    (0, 2): (2210.2236124548363, -2017.52334943521, 1498.081172457456, -718.6359919632359, 146.4037555781616, -4.9892131862671505),
    (0, 3): (-592.743745734632, 1591.873781627888, -1207.261522487504, 608.785486935364, -105.4993508931208),
    (0, 4): (290.12956292128547, -973.091553087975, 602.603274510125, -276.361526170076, 32.40953340386105),
    (0, 5): (-113.90630790850321, 381.06836198507096, -133.7383902842754, 49.023632509086724),
    (0, 6): (21.35571525415769, -67.41756835751434),
    (2, 0): (0.0, 729.116529735046, -343.956902961561, 124.687671116248, -31.656964386073, 7.04658803315449),
    (2, 1): (1760.062705994408, -1721.528607567954, 674.819060538734, -356.629112415276, 88.4080716616, -15.84003094423364),
    (2, 2): (-675.802947790203, 2082.7344423998043, -614.668925894709, 340.685093521782, -33.3848202979239),
    (2, 3): (365.7041791005036, -1190.914967948748, 298.904564555024, -145.9491676006352),
    (2, 4): (-108.30162043765552,),
    (2, 5): (12.78101825083098,),
    (3, 0): (0.0, -175.292041186547, 83.1923927801819, -29.483064349429),
    (3, 1): (-86.1329351956084, 766.116132004952, -108.3834525034224, 51.2796974779828),
    (3, 2): (-30.0682112585625, -1380.9597954037708),
    (3, 3): (3.50240264723578, 938.26075044542),
    (4, 0): (0.0, -22.6683558512829),
    (4, 1): (-137.1145018408982,),
    (4, 2): (148.10030845687618,),
    (4, 3): (-68.5590309679152,),
    (4, 4): (12.4848504784754,),
}
#: Fixed values of the Gibbs function's derivative by pressure at 0 degrees: rows by power of the salinity root, along pressure.
GIBBS_COLD = {
    0: (100015.695367145, -5089.1530840726, 853.5533353388611, -133.2587017014444, 21.0131554401542, -3.278571068826234),
    2: (-3310.49154044839, 769.588305957198, -289.5972960322374, 63.3632691067296, -13.1240078295496),
    3: (199.459603073901, -104.588181856267, 204.1334828179377, -13.65007729765128),
    4: (-54.7919133532887, -8.16387957824522, -90.52653359134831),
    5: (36.0284195611086,),
}
#: Fixed values of the first guess of potential temperature.
GUESS = (8.65483913395442e-6, -1.41636299744881e-6, -7.38286467135737e-9, -8.38241357039698e-6, 2.83933368585534e-8, 1.77803965218656e-8, 1.71155619208233e-10)
#: Fixed values of the enthalpy of standard seawater at 0 degrees along pressure, times 1e-8.
STANDARD_ENTHALPY = (0.0, 9.726613854843870e-4, -2.252956605630465e-5, 2.376909655387404e-6, -1.664294869986011e-7, -5.988108894465758e-9, -2.1078768810e-9, 2.8019291329e-10)

Terms = dict[tuple[int, int, int], float]


def terms(rows: dict) -> Terms:
    """Powers of three variables and their factors, of a table of rows."""
    return {((*k, i) if isinstance(k, tuple) else (k, i, 0)): c for k, row in rows.items() for i, c in enumerate(row)}


def derived(polynomial: Terms, axis: int) -> Terms:
    """The derivative by one of the variables."""
    lower = lambda k: tuple(p - (n == axis) for n, p in enumerate(k))
    return {lower(k): c * k[axis] for k, c in polynomial.items() if k[axis]}


V, H, S = terms(VOLUME), terms(ENTHALPY), terms(ENTROPY)
#: The Gibbs function's derivative by pressure: entropy's own, summed up along temperature, and what does not change with it.
G_Z = {(i, j + 1, k - 1): c * k / (j + 1) for (i, j, k), c in S.items() if k} | {(i, 0, k): c for i, row in GIBBS_COLD.items() for k, c in enumerate(row)}


def nested(polynomial: Terms, variables: list, number: Callable = float, plus: Callable = lambda a, b: a + b, times: Callable = lambda a, b: a * b):
    """A polynomial by Horner's rule, the last variable inmost; with plus and times of text it is written out."""
    if not variables:
        return number(polynomial[()])
    rows: dict[int, Terms] = {}
    for (power, *rest), c in polynomial.items():
        rows.setdefault(power, {})[tuple(rest)] = c
    inner = {p: nested(r, variables[1:], number, plus, times) for p, r in rows.items()}

    def down(acc, power: int):
        acc = times(acc, variables[0])
        return plus(acc, inner[power]) if power in inner else acc

    return reduce(down, range(max(inner) - 1, -1, -1), inner[max(inner)])


def nested_sql(polynomial: Terms, variables: list[str]) -> str:
    """The same as SQL text with double literals."""
    return nested(polynomial, variables, lambda c: f"{c:.17e}", "({} + {})".format, "{} * {}".format)


def column(polynomial: Terms, *variables: Column) -> Column:
    return nested(polynomial, list(variables), F.lit)


def let(values: dict[str, Column], use: Callable[[Column], Column]) -> Column:
    """Bind values that an expression uses many times."""
    return F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), use)[0]


class Steps:
    """A frame that gets values which expressions use many times as columns of their own, in one select behind another.

    Its `let` stands in for the function of that name, whose lambdas Spark interprets row by row; selects are compiled.
    Take expressions built with it from its `frame`, and drop what they need with a last select.
    """

    def __init__(self, frame: DataFrame) -> None:
        self.frame, self.count = frame, 0

    def let(self, values: dict[str, Column], use: Callable[[dict[str, Column]], Column]) -> Column:
        names = {n: f"_step{self.count}_{n}" for n in values}
        self.count += 1
        self.frame = self.frame.withColumns({names[n]: v for n, v in values.items()})
        return use({n: F.col(name) for n, name in names.items()})


def _salt(sa: Column) -> Column:
    return F.when(sa < 0, 0.0).otherwise(sa) * SFAC


def potential_temperature(sa: Column, t: Column, p: Column, let: Callable = let) -> Column:
    """Potential temperature at the surface from temperature in place (ITS-90)."""
    zero, bend = {k: c for k, c in S.items() if k[2] == 0}, derived(S, 1)
    flat = {k: c for k, c in bend.items() if k[2] == 0}
    zero2, flat2 = ({k[:2]: c for k, c in x.items()} for x in (zero, flat))
    g = GUESS

    def begin(q: Column) -> Column:
        s1 = q["sa"] * (35 / SSO)
        guess = q["t"] + q["p"] * (g[0] + s1 * g[1] + q["p"] * g[2] + q["t"] * (g[3] + s1 * g[4] + q["t"] * g[5] + q["p"] * g[6]))
        part = column(S, q["x"], q["t"] * Y, q["p"] * Z)
        return let({"x": q["x"], "sa": q["sa"], "part": part, "pt": guess}, lambda r: let({"x": r["x"], "part": r["part"], "pt": r["pt"], "slope": -CP0 / ((r["pt"] + 273.15) * (1 - 0.05 * (1 - r["sa"] / SSO))) / Y}, lambda u: step(u, 2)))

    def step(r: Column, left: int) -> Column:
        """Newton's step with the slope halfway; values are entropies times -40, slopes by degree."""
        off = column(zero2, r["x"], r["pt"] * Y) - r["part"]
        return let({"x": r["x"], "part": r["part"], "old": r["pt"], "off": off, "new": r["pt"] - off / r["slope"]}, lambda u: halfway(u, left))

    def halfway(u: Column, left: int) -> Column:
        slope = column(flat2, u["x"], (u["new"] + u["old"]) * (0.5 * Y)) * Y
        return let({"x": u["x"], "part": u["part"], "slope": slope, "pt": u["old"] - u["off"] / slope}, (lambda r: step(r, left - 1)) if left > 1 else (lambda r: r["pt"]))

    return let({"sa": F.when(sa < 0, 0.0).otherwise(sa), "t": t, "p": p, "x": F.sqrt(_salt(sa))}, begin)


def conservative_temperature_of_potential(sa: Column, pt: Column, let: Callable = let) -> Column:
    h = {k[:2]: c for k, c in H.items()}
    return let({"x": F.sqrt(_salt(sa)), "y": pt * Y}, lambda q: column(h, q["x"], q["y"]) / CP0)


def conservative_temperature(sa: Column, t: Column, p: Column, let: Callable = let) -> Column:
    """From temperature in place (ITS-90)."""
    return conservative_temperature_of_potential(sa, potential_temperature(sa, t, p, let), let)


def _at(sa: Column, ct: Column, p: Column, use: Callable[[Column], Column], let: Callable = let) -> Column:
    return let({"x": F.sqrt(_salt(sa) + OFFSET), "y": ct * Y, "z": p * Z}, use)


def specific_volume(sa: Column, ct: Column, p: Column, let: Callable = let) -> Column:
    return _at(sa, ct, p, lambda q: column(V, q["x"], q["y"], q["z"]), let)


def density(sa: Column, ct: Column, p: Column, let: Callable = let) -> Column:
    return 1 / specific_volume(sa, ct, p, let)


def sigma0(sa: Column, ct: Column, let: Callable = let) -> Column:
    """Potential density at the surface minus 1000."""
    return density(sa, ct, F.lit(0.0), let) - 1000


def sound_speed(sa: Column, t: Column, p: Column, let: Callable = let) -> Column:
    """m/s, from temperature in place (ITS-90), by the derivatives of the Gibbs function."""
    by_z, by_zz, by_ty, by_tz = G_Z, derived(G_Z, 2), derived(S, 1), derived(S, 2)

    def use(q: Column) -> Column:
        v, vz, cy, cz = (column(x, q["x"], q["y"], q["z"]) for x in (by_z, by_zz, by_ty, by_tz))
        return let({"v": v, "vz": vz, "cy": cy, "cz": cz}, lambda r: r["v"] * F.sqrt(r["cy"] / (r["cz"] * r["cz"] - r["cy"] * r["vz"])))

    return let({"x": F.sqrt(_salt(sa)), "y": t * Y, "z": p * Z}, use)


def _surface_gravity(lat: Column) -> Column:
    s = F.pow(F.sin(F.radians(lat)), F.lit(2.0))
    return GRAVITY[0] * (1 + (GRAVITY[1] + GRAVITY[2] * s) * s)


def height(p: Column, lat: Column, let: Callable = let) -> Column:
    """Height of a pressure in metres, negative in the sea."""
    enthalpy = nested({(i,): c for i, c in enumerate(STANDARD_ENTHALPY)}, [p * Z], F.lit) * 1e8
    return let({"b": _surface_gravity(lat), "c": enthalpy}, lambda q: -2 * q["c"] / (q["b"] + F.sqrt(q["b"] * q["b"] + 2 * GAMMA * q["b"] * q["c"])))


def gravity(p: Column, lat: Column, let: Callable = let) -> Column:
    return _surface_gravity(lat) * (1 - GAMMA * height(p, lat, let))


def n_squared(sa: Column, ct: Column, p: Column, next_sa: Column, next_ct: Column, next_p: Column, lat: Column, let: Callable = let) -> Column:
    """Buoyancy frequency squared (1/s2) between two samples of a cast, at their mid pressure; null without a next one."""
    by_x, by_y = derived(V, 0), derived(V, 1)

    def use(q: Column) -> Column:
        v, x = column(V, q["x"], q["y"], q["z"]), q["x"]
        expansion = column(by_y, x, q["y"], q["z"]) * Y
        contraction = column(by_x, x, q["y"], q["z"]) * SFAC / (2 * x)
        # Volume falls with salinity and rises with temperature; both as parts of the volume.
        return F.pow(q["g"], F.lit(2.0)) * F.try_divide(-(expansion * q["dct"] + contraction * q["dsa"]), v * v * 1e4 * q["dp"])

    values = {
        "x": F.sqrt(_salt((sa + next_sa) / 2) + OFFSET), "y": (ct + next_ct) * (Y / 2), "z": (p + next_p) * (Z / 2), "g": (gravity(p, lat, let) + gravity(next_p, lat, let)) / 2,
        "dct": next_ct - ct, "dsa": next_sa - sa, "dp": next_p - p,
    }
    return let(values, use)
