"""Small invented source files in every layout, with the oddities the loads must handle."""

from __future__ import annotations

import csv
import pathlib

YEARS = list(range(2014, 2017))


def write(path: pathlib.Path, header: list[str], rows: list[list], bom: bool = False) -> str:
    with open(path, "w", newline="", encoding="utf-8-sig" if bom else "utf-8") as handle:
        writer = csv.writer(handle, lineterminator="\n")
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def year_wide(path, states: dict[str, list]) -> str:
    """States by year with an average column, a territory and an unnamed total row."""
    rows = [[state, *values, 0] for state, values in states.items()]
    rows += [["Guam", 5, 5, 5, 5], ["", "9.9E+20", 1, 1, 1]]
    return write(path, ["State Name", *YEARS, "14-16 Average"], rows)


def source_files(folder: pathlib.Path) -> dict[str, str]:
    """Paths by source name; what the files hold is spelled out in the tests."""
    at = {}
    at["arc_co_payments"] = year_wide(folder / "a.csv", {"Alabama": ["10.005", 2, 3], " Iowa ": ["", 5, 6.5]})
    at["arc_ic_payments"] = year_wide(folder / "b.csv", {"Iowa": [1, 1, 1], "Ohio": [2, 2, 2]})
    at["plc_payments"] = year_wide(folder / "c.csv", {"Ohio": [7, 8, "9.125"]})
    at["arc_co_base_acres"] = year_wide(folder / "d.csv", {"Alabama": ["100.255", 200, 300]})
    at["plc_base_acres"] = year_wide(folder / "e.csv", {"Ohio": [1, 2, ""], "Alaska": [1, 1, 1]})
    at["arc_co_recipients"] = year_wide(folder / "f.csv", {"Alabama": [3, 4, 5], "Iowa": [6, 7, 8]})
    at["arc_ic_recipients"] = year_wide(folder / "g.csv", {"Iowa": [1, 2, 3]})
    at["plc_recipients"] = year_wide(folder / "h.csv", {"Ohio": [4, 5, 6]})
    at["dairy_disaster"] = write(
        folder / "i.csv",
        [" state", "year", "program", "payments ", "count"],
        [
            ["Iowa ", 2013, "Dairy", "100.5", "2"],
            ["Ohio", 2014, "DMC", "", ""],
            ["Ohio", 2014, "MPP", "3.255", "NA"],
            ["Guam", 2014, "LFP", 7, 1],
            ["Texas", 2015, "ELAP", 8, 1],
            ["Texas", 2015, "NAP", 9, 1],
            ["Texas", 2015, "TAP", 9, 3],
        ],
    )
    practice = ["Pay_year", "State", "payments", "category_name", "practice_code", "full_practice_code "]
    at["eqip"] = write(
        folder / "j.csv",
        practice,
        [
            [2014, "Iowa", "1.005", "Land management", "340", "E340A "],
            [2014, "Iowa", 2, "Soil remediation (6(A)(vi)", "340", " B000CPL24"],
            [2014, "Iowa", 2, "Other 2 - improvement", "340", "340"],
            [2014, "Iowa", 3, "", "", ""],
            [2014, "Iowa", "", "Structural", "340", "340"],
            [2011, "Iowa", 4, "Structural", "340", "340"],
            [2014, "Puerto Rico", 5, "Structural", "340", "340"],
            [2016, "Ohio", 6, "Structural", "999", "E999X"],
        ],
    )
    at["csp"] = write(
        folder / "k.csv",
        ["year", "state", "payments", "StatutoryCategory", "practice_code", "full_practice_code"],
        [[2015, "Ohio", 10, "NIPF", "OTP", "OTP"], [2015, "Ohio", 11, "Structural", "", ""]],
    )
    groups = [
        "Total CRP",
        "Total General Sign-Up",
        "Total Continuous",
        "CREP Only",
        "Continuous Non-CREP",
        "Farmable Wetland",
        "Grassland",
    ]
    measures = ["ANNUAL RENTAL PAYMENTS ($1000)", "NUMBER OF CONTRACTS", "NUMBER OF FARMS", "ACRES"]
    header = ["year", "state", *[f"{group} - {measure} " for group in groups for measure in measures]]

    def reserve(year, state, missing=()):
        cells = []
        for place in range(len(groups)):
            cells += ["" if place in missing else f"{place + 1}.12345", place + 10, place + 20, f"{place}.5"]
        return [year, state, *cells]

    at["crp"] = write(
        folder / "l.csv",
        header,
        [
            reserve(2014, "NEW YORK"),
            reserve(2015, "IOWA", missing=(6,)),
            reserve(2014, "DISTRICT OF COLUMBIA"),
            reserve(2001, "IOWA"),
            reserve(2014, "U.S."),
        ],
    )
    easement = [
        "year",
        "state",
        "program",
        "Number of Contracts",
        "Number of Acres",
        "Total Financial Assistance Payments ($1000)",
        "Total Payments",
    ]
    for name, path in (("acep", "m.csv"), ("rcpp", "n.csv")):
        at[name] = write(
            folder / path,
            easement,
            [
                [2014, "Alaska ", name, 1, 56.8, "577.12345", 0],
                [2014, "Hawaii/Pacific ", name, 1, 1, 2, 0],
                [2015, "Iowa", name, 2, 3, "", 0],
                [2024, "Iowa", name, 2, 3, 4, 0],
            ],
        )
    at["snap_costs"] = write(
        folder / "o.csv",
        ["State", 2013, *YEARS, "Total"],
        [["IA", 1, 10, 20, 30, 60], ["DC", 1, 1, 2, 3, 6], ["Total", "2E+30", 11, 22, 33, 66]],
        bom=True,
    )
    at["snap_participation"] = write(
        folder / "p.csv",
        ["State", *YEARS, "Avg."],
        [["IA", "438558.8333", "2.5", "3.4", 1], ["Total", 1, 2, 3, 1]],
        bom=True,
    )
    at["crop_insurance"] = write(
        folder / "q.csv",
        [
            "state",
            "year",
            "policies_prem",
            "acres_insured",
            "liabilities",
            "premium",
            "subsidy",
            "indemnity",
            "farmer_premium",
            "loss_ratio",
            "net_benefit",
        ],
        [
            ["IA", 2014, 5, 1.5, 1000, 100, 60, 50, 40, 0.5, 10],
            ["PR", 2015, 1, 1, 10, 0, 0, 0, 0, "", 0],
            ["XX", 2015, 1, 1, 10, 0, 0, 0, 0, 0, 0],
            ["IA", 2013, 1, 1, 1, 1, 1, 1, 1, 1, 1],
        ],
    )
    at["practices"] = write(
        folder / "r.csv",
        ["practice_code", "practice_name", "source"],
        [["340", "Cover Crop", "EQIP"], ["000", "Bundle", "CSP"], ["OTP", "Other Payment", "CSP"]],
    )
    return at
