"""Label and flag expressions of the refresh.

Pure ``Column -> Column`` builders over built-in functions only, so every
expression stays inside whole-stage codegen.

Text semantics: service names compare exactly; ``mode`` is lower-cased; the
"blank" test is ``rtrim(x) = ''`` (used only as a test, the value itself is
returned untrimmed); ``LEN`` is ``length(rtrim(x))``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must equal the reference's ---------------------------
FIXED_ROUTE_SERVICE = "AGENCY_FIXED_ROUTE"
DEMAND_RESPONSE_SERVICE = "AGENCY_DEMAND_RESPONSE"
KNOWN_PROVIDERS = ("AGENCY_FIXED_ROUTE", "AGENCY_DEMAND_RESPONSE", "BIKESHARE",
                   "SCOOTER_VENDOR", "RIDESHARE_VENDOR")
UNKNOWN_PROVIDER = "(UNKNOWN)"
UNKNOWN_ROUTE = "(UNKNOWN_ROUTE)"
NA_LABEL = "(NA)"
NO_STOP = "(NO_STOP)"
FIXED_ROUTE = "FIXED_ROUTE"
DEMAND_RESPONSE = "DEMAND_RESPONSE"
WALK = "WALK"
OTHER = "OTHER"
# lower(mode) -> service group, checked after the two agency services
MODE_GROUPS = (("walk", "WALK"), ("bike", "BIKE"), ("bikeshare", "BIKE"),
               ("scooter", "SCOOTER"), ("rideshare", "RIDESHARE"),
               ("transit", "OTHER_TRANSIT"))
TRANSFER_TYPES = ("FIXED_TO_DEMAND", "DEMAND_TO_FIXED", "ROUTE_CHANGE", "OTHER")
BG_LENGTH = 12
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nonblank(x) -> Column:
    """``NULLIF(x, '')`` with trailing-blank padding: null when x is null or blank."""
    x = _c(x)
    return F.when(F.rtrim(x) != F.lit(""), x)


def coalesce_blank(x, default: str) -> Column:
    """``COALESCE(NULLIF(x, ''), default)``."""
    return F.coalesce(nonblank(x), F.lit(default))


def padded(x) -> Column:
    """Text as a comparison with blank padding sees it: null and blanks are
    empty, trailing blanks do not count."""
    return F.rtrim(F.coalesce(_c(x), F.lit("")))


def text_len(x) -> Column:
    """``LEN(x)``: length without trailing blanks."""
    return F.length(F.rtrim(_c(x)))


def service_group(service, mode) -> Column:
    """Reporting group of a leg; the first matching arm wins."""
    service, m = _c(service), F.lower(_c(mode))
    expr = (F.when(service == FIXED_ROUTE_SERVICE, F.lit(FIXED_ROUTE))
            .when(service == DEMAND_RESPONSE_SERVICE, F.lit(DEMAND_RESPONSE)))
    for mode_value, group in MODE_GROUPS:
        expr = expr.when(m == mode_value, F.lit(group))
    return expr.otherwise(F.lit(OTHER))


def provider_name(service) -> Column:
    """Known services pass through, everything else is ``(UNKNOWN)``."""
    service = _c(service)
    return F.when(service.isin(*KNOWN_PROVIDERS), service).otherwise(F.lit(UNKNOWN_PROVIDER))


def to_route_label(service, route, mode) -> Column:
    """Label of the route a leg rides; never null."""
    service = _c(service)
    return (F.when(service == DEMAND_RESPONSE_SERVICE, F.lit(DEMAND_RESPONSE))
            .when(service == FIXED_ROUTE_SERVICE, coalesce_blank(route, UNKNOWN_ROUTE))
            .when(F.lower(_c(mode)) == "walk", F.lit(WALK))
            .otherwise(coalesce_blank(route, NA_LABEL)))


def from_route_label(prev_service, prev_route) -> Column:
    """Label of the previous leg's route; null when the previous service is null."""
    prev_service = _c(prev_service)
    return (F.when(prev_service == DEMAND_RESPONSE_SERVICE, F.lit(DEMAND_RESPONSE))
            .when(prev_service == FIXED_ROUTE_SERVICE, coalesce_blank(prev_route, UNKNOWN_ROUTE))
            .when(prev_service.isNull(), F.lit(None).cast("string"))
            .otherwise(coalesce_blank(prev_route, NA_LABEL)))


def _transfer_arms(prev_service, service, prev_route, route):
    prev_service, service = _c(prev_service), _c(service)
    fixed_to_demand = (prev_service == FIXED_ROUTE_SERVICE) & (service == DEMAND_RESPONSE_SERVICE)
    demand_to_fixed = (prev_service == DEMAND_RESPONSE_SERVICE) & (service == FIXED_ROUTE_SERVICE)
    route_change = ((prev_service == FIXED_ROUTE_SERVICE) & (service == FIXED_ROUTE_SERVICE)
                    & (padded(prev_route) != padded(route)))
    return prev_service.isNull(), fixed_to_demand, demand_to_fixed, route_change


def is_transfer_leg(prev_service, service, prev_route, route) -> Column:
    """1 when the leg changes agency service or fixed route, else 0."""
    first, f2d, d2f, rc = _transfer_arms(prev_service, service, prev_route, route)
    return (F.when(first, F.lit(0)).when(f2d | d2f | rc, F.lit(1)).otherwise(F.lit(0)))


def transfer_type(prev_service, service, prev_route, route) -> Column:
    """FIXED_TO_DEMAND / DEMAND_TO_FIXED / ROUTE_CHANGE / OTHER; null on a first leg."""
    first, f2d, d2f, rc = _transfer_arms(prev_service, service, prev_route, route)
    return (F.when(first, F.lit(None).cast("string"))
            .when(f2d, F.lit(TRANSFER_TYPES[0]))
            .when(d2f, F.lit(TRANSFER_TYPES[1]))
            .when(rc, F.lit(TRANSFER_TYPES[2]))
            .otherwise(F.lit(TRANSFER_TYPES[3])))


def related_service(service) -> Column:
    """Transit service next to a walk leg."""
    service = _c(service)
    return (F.when(service == FIXED_ROUTE_SERVICE, F.lit(FIXED_ROUTE))
            .when(service == DEMAND_RESPONSE_SERVICE, F.lit(DEMAND_RESPONSE))
            .otherwise(F.lit(OTHER)))


def related_route(service, route) -> Column:
    """Route next to a walk leg."""
    service = _c(service)
    return (F.when(service == DEMAND_RESPONSE_SERVICE, F.lit(DEMAND_RESPONSE))
            .when(service == FIXED_ROUTE_SERVICE, coalesce_blank(route, UNKNOWN_ROUTE))
            .otherwise(F.lit(NA_LABEL)))


def stop_key(stop_name) -> Column:
    """Stop name or ``(NO_STOP)``."""
    return coalesce_blank(stop_name, NO_STOP)


SIGNIFICANT = 6


def tsql_float_text(x) -> Column:
    """Text of a float inside T-SQL ``CONCAT``: at most 6 significant
    digits, trailing zeros removed, and from 1e6 up or below 1e-4 a mantissa with
    an exponent of three digits (``1.23457e+006``). Null, NaN and infinities are
    null, as a float column holds no others."""
    x = _c(x).cast("double")
    shown = F.format_string(f"%.{SIGNIFICANT - 1}e", x)  # d.ddddde+xx
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    digits = F.rtrim(F.translate(F.substring_index(shown, "e", 1), "-.", ""), F.lit("0"))
    e = F.substring_index(shown, "e", -1).try_cast("int")
    n = F.length(digits)

    def some(at: Column, size: Column) -> Column:
        return F.call_function("substring", digits, at, size)

    one = F.lit(1)
    whole = F.rpad(some(one, e + 1), e + 1, "0")
    fixed = F.when(e < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)).otherwise(
        F.concat(whole, F.when(n > e + 1, F.concat(F.lit("."), some(e + 2, n))).otherwise(F.lit(""))))
    mantissa = F.concat(some(one, one), F.when(n > 1, F.concat(F.lit("."), some(F.lit(2), n))).otherwise(F.lit("")))
    power = F.concat(F.when(e < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.abs(e).cast("string"), 3, "0"))
    text = F.concat(sign, F.when((e >= SIGNIFICANT) | (e < -4), F.concat(mantissa, power)).otherwise(fixed))
    finite = ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.when(x == 0, F.lit("0")).when(finite, text)


def round_places(x, places: int = 4) -> Column:
    """``ROUND(x, places)`` of a float. Numbers so large that they have no such
    places stay as they are (Spark's round would go through a decimal)."""
    x = _c(x).cast("double")
    return F.when(F.abs(x) < 1e11, F.round(x, places)).otherwise(x)


def hotspot_key(stop_name, lon, lat) -> Column:
    """Stop name, else ``COORD_<lon>_<lat>`` rounded to 4 places.
    A null coordinate is empty text (T-SQL ``CONCAT``), so the key is never null."""
    coord = F.concat(F.lit("COORD_"),
                     F.coalesce(tsql_float_text(round_places(lon)), F.lit("")), F.lit("_"),
                     F.coalesce(tsql_float_text(round_places(lat)), F.lit("")))
    return F.coalesce(nonblank(stop_name), coord)


def bg_is_valid(bg) -> Column:
    """block group present and 12 characters long."""
    bg = _c(bg)
    return bg.isNotNull() & (text_len(bg) == BG_LENGTH)
