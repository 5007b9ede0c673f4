"""Build raw staffing records (all strings, original headers) for fixtures."""

from __future__ import annotations

from shiftlens import config as C

DEFAULTS = {
    "PROVNUM": "015001", "PROVNAME": "FACILITY", "CITY": "CITY_1", "STATE": "al",
    "COUNTY_NAME": "BUTLER", "COUNTY_FIPS": "1013", "CY_Qtr": "2024Q2", "WorkDate": "20240401",
    "MDScensus": "10",
}


def raw_frame(spark, rows: list[dict], columns: list[str] | None = None):
    cols = columns or C.raw_columns()
    data = []
    for r in rows:
        rec = {c: "0.0" for c in C.raw_hour_columns()}
        rec.update(DEFAULTS)
        rec.update(r)
        data.append(tuple(None if rec.get(c) is None else str(rec.get(c)) for c in cols))
    schema = ", ".join(f"`{c}` string" for c in cols)
    return spark.createDataFrame(data, schema)


def hours(rn: float, lpn: float = 0.0, cna: float = 0.0, rn_ctr: float = 0.0, lpn_ctr: float = 0.0,
          cna_ctr: float = 0.0) -> dict:
    return {"Hrs_RN": rn, "Hrs_LPN": lpn, "Hrs_CNA": cna, "Hrs_RN_ctr": rn_ctr, "Hrs_LPN_ctr": lpn_ctr,
            "Hrs_CNA_ctr": cna_ctr, "Hrs_RN_emp": rn - rn_ctr, "Hrs_LPN_emp": lpn - lpn_ctr,
            "Hrs_CNA_emp": cna - cna_ctr}
