"""A small demand file: twelve weeks, four stores, five families, numbers drawn from hashes."""

import datetime
import hashlib
import math

START = datetime.date(2023, 3, 6)
LEVELS = {"BREAD": 64.0, "CANDLES": 9.0, "COFFEE": 31.0, "FRUIT": 88.0, "SOAP": 17.5}
SIZES = {2: 1.0, 4: 0.55, 7: 1.8, 11: 0.8}


def draw(*key):
    """A number in [0, 1) that depends on the key alone."""
    return int.from_bytes(hashlib.sha256(repr(key).encode()).digest()[:4], "big") / 2**32


def demand_lines():
    for family, level in LEVELS.items():
        for store, size in SIZES.items():
            for week in range(12):
                for weekday in range(7):
                    day = START + datetime.timedelta(weeks=week, days=weekday)
                    offers = int(4 * draw("offers", family, store, week) ** 2)
                    swing = 1 + 0.3 * math.sin(0.9 * weekday + len(family)) + 0.02 * week
                    reaction = 1 + offers * (0.12 if level > 10 else -0.08)
                    volume = level * size * swing * reaction * (0.5 + draw(family, store, day.isoformat()))
                    yield f"{day},{store},{family},{volume:.2f},{offers}"


def write_sample(folder):
    folder.mkdir(parents=True, exist_ok=True)
    lines = ["date,store_nbr,family,sales,onpromotion", *demand_lines()]
    (folder / "train.csv").write_text("\n".join(lines) + "\n")
    stores = "".join(f"{store},Town {store},{size}\n" for store, size in SIZES.items())
    (folder / "stores.csv").write_text("store_nbr,city,size\n" + stores)
