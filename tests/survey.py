"""Small survey files, and what must come out of them worked out in plain Python."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from tallymart.plans import codebook as codes

YEARS = (2018, 2019, 2020)
KEY = ("DIRECTORIO", "SECUENCIA_ENCUESTA", "SECUENCIA_P", "ORDEN")


def text(path, header, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "\r\n".join(";".join("   " if v is None else v for v in line) for line in [header, *lines])
    path.write_bytes(b"\xef\xbb\xbf" + (body + "\r\n").encode())


def generate(root, seed=11, dwellings=40):
    """Writes the files; returns {module: {year: [row as dict]}}."""
    rng = random.Random(seed)
    out = {"dwelling": {}, "member": {}, "education": {}}
    flag = lambda: rng.choice(["1", "2", None, " 1", "9"])
    for year in YEARS:
        homes, people, schooling = [], [], []
        for d in range(dwellings):
            home = f"{d:03d}" if d % 5 else str(d)
            households = rng.choice([1, 1, 2, 4])
            for h in range(1, households + 1):
                row = {
                    "DIRECTORIO": home, "SECUENCIA_ENCUESTA": str(h), "SECUENCIA_P": "1",
                    "ORDEN": "1", "CANT_HOG_COMPLETOS": str(households),
                    "P1070": rng.choice(["1", "5", "99", None]),
                    "CLASE": rng.choice(["1", "2"]), "FEX_C": "12,5",
                    "REGION": rng.choice([*"123456789", "10", None]),
                }
                for c in ("P4005", "P4015", "P4567"):
                    row[c] = rng.choice(["1", "7", "9"])
                for c in ("P8520S1", "P8520S5", "P8520S3", "P8520S4", "P4065S1", "P4065S2",
                          "P4065S3", "P4065S4", "P1891S1", "P1891S2"):
                    row[c] = flag()
                homes.append(row)
                if rng.random() < 0.1:
                    homes.append(dict(row))
            for p in range(1, rng.randint(2, 5)):
                key = {
                    "DIRECTORIO": home, "SECUENCIA_ENCUESTA": str(rng.randint(1, households)),
                    "SECUENCIA_P": " 1 ", "ORDEN": f"{p}.0" if p == 2 else str(p),
                }
                person = {
                    **key, "P6020": rng.choice(["1", "2", "3"]),
                    "P6040": rng.choice(["3", "17", "18", "45", "60", "abc", None]),
                    "P5502": "6", "P6080": "6", "P1895": "10", "P1896": "x", "P1897": None,
                    "P756": rng.choice(["1", "2", "3", None, "7"]),
                    "P756S1": "5", "P756S2": rng.choice(["5001", "5002", "8001", "1", None]),
                    "LLAVEHOG": f"{home}-1", "FEX_C": rng.choice(["2072,536", "1,234,5", "3"]),
                }
                people.append(person)
                if rng.random() < 0.1:
                    people.append({**person, "P6020": "2"})
                if rng.random() < 0.8:
                    record = {
                        **key, "P6160": flag(), "P8586": rng.choice(["1", "1", "2", None]),
                        "P8587": rng.choice(["1", "13", "14"]), "P8587S1": "7.9", "P6211": "3",
                        "P6218": "16", "P5673": "1", "P1101": "5",
                        "P8610": flag(),
                        "P8610S1": rng.choice([None, "1000,005", "999999999999999,00", "n/a"]),
                        "P6229": "2", "P8612": flag(), "P8612S1": "10,5",
                        "P8614": flag(), "P8614S1": None, "LLAVEHOG": "z", "FEX_C": "1",
                    }
                    schooling.append(record)
                    if rng.random() < 0.1:
                        schooling.append(dict(record))
        if year == 2020:
            people.append({**people[0], "ORDEN": "x"})
        if year == 2018:
            for row in homes:
                del row["REGION"]
        if year == 2019:
            for row in people + schooling:
                del row["LLAVEHOG"]
        for module, stem, table in (
            ("dwelling", "Datos_de_la_vivienda_Actualizada", homes),
            ("member", "Caracteristicas_y_composicion_del_hogar", people),
            ("education", "Educación", schooling),
        ):
            header = list(table[0])
            if year == 2020:
                header.reverse()
            text(
                root / str(year) / f"{stem}{year}.csv", header,
                [[r[c] for c in header] for r in table],
            )
            out[module][year] = table
    return out


def whole(value):
    try:
        return int(Decimal((value or "").strip()))
    except InvalidOperation:
        return None


def money(value):
    try:
        amount = Decimal((value or "").replace(",", ".")).quantize(Decimal("0.01"), ROUND_HALF_UP)
    except InvalidOperation:
        return Decimal("0.00")
    return amount if abs(amount) < Decimal(10) ** 12 else Decimal("0.00")


def yes(row, *names):
    return any(row.get(n) == "1" for n in names)


def person_key(row, year):
    return (row["DIRECTORIO"], *[whole(row[k]) for k in KEY[1:]], year)


def expected_fact(data):
    """person key -> (region, counts of the fact), rows with one value per key only."""
    facts = {}
    for year in YEARS:
        home = {}
        for row in data["dwelling"][year]:
            at = row["DIRECTORIO"]
            if at not in home or whole(row["SECUENCIA_ENCUESTA"]) < whole(home[at]["SECUENCIA_ENCUESTA"]):
                home[at] = row
        record = {person_key(r, year): r for r in data["education"][year]}
        for row in data["member"][year]:
            key = person_key(row, year)
            edu, place = record.get(key, {}), home[row["DIRECTORIO"]]
            facts[key] = {
                "region": codes.REGION.get(place.get("REGION")),
                "has_record": key in record,
                "students": int(yes(edu, "P8586")),
                "scholars": int(yes(edu, "P8610")),
                "subsidised": int(yes(edu, "P8612")),
                "credited": int(yes(edu, "P8614")),
                "supported": int(yes(edu, "P8610", "P8612", "P8614")),
                "persons_at_risk": int(yes(place, "P4065S1", "P4065S2", "P4065S3", "P4065S4")),
                "persons_unserved": int("2" in [place.get(c) for c in ("P8520S1", "P8520S5", "P8520S3")]),
                "scholarship_amount": money(edu.get("P8610S1")),
                "subsidy_amount": money(edu.get("P8612S1")),
                "credit_amount": money(edu.get("P8614S1")),
            }
    return facts
