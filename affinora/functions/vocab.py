"""Attribute vocabularies of the similarity metrics.

Two values agree when they share a group. The tables are the rule's data; pass other ones to replace them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: attributes that count for each product group
RELEVANT = {
    "Outerwear": ["gender", "color", "type", "decoration_technology", "decoration_location"],
    "Polos": ["gender", "color", "decoration_technology", "sleeve_style", "decoration_location"],
    "T-shirts": ["gender", "color", "decoration_technology", "sleeve_style", "decoration_location"],
    "Sweaters": ["gender", "color", "type", "decoration_technology", "decoration_location"],
    "Dress Shirts": ["gender", "color", "decoration_technology", "sleeve_style", "decoration_location"],
    "Sportswear": ["gender", "color", "decoration_technology", "sleeve_style", "decoration_location"],
    "Bottoms": ["gender", "color", "type", "decoration_technology", "decoration_location"],
    "Hats": ["fit_type", "color", "type", "decoration_technology", "decoration_location"],
    "Beanies": ["fit_type", "color", "type", "decoration_technology", "decoration_location"],
}

# fixed values: product groups that may substitute each other
COMPARABLE_GROUPS = {
    "Outerwear": ["Outerwear"], "Hats": ["Beanies", "Hats"], "T-shirts": ["T-shirts"], "Polos": ["Polos"],
    "Sweaters": ["Sweaters"], "Sportswear": ["Sportswear"], "Dress Shirts": ["Dress Shirts"],
    "Beanies": ["Beanies", "Hats"], "Bottoms": ["Bottoms"],
}

# fixed values: garment types
TYPE_GROUPS = {
    "outerwear": ["SOFTSHELL", "JACKET", "INSULATED", "LIGHTWEIGHT", "JACKET, LIGHTWEIGHT", "JACKET, FLEECE & KNITS", "3-IN-1",
                  "JACKET, SOFTSHELL", "FLEECE JACKETS & KNITS", "OUTERWEAR"],
    "sweatshirt": ["SWEATER", "FLEECE & KNITS", "SWEATSHIRT", "SWEATSHIRT, FLEECE & KNITS", "CARDIGAN", "JACKET, FLEECE & KNITS",
                   "HOODIES", "FLEECE JACKETS & KNITS", "SWEATERS & SWEATSHIRTS", "SWEATERS"],
    "dress shirt": ["DRESS SHIRT", "WOVEN SHIRT", "BLOUSE", "WORK WEAR", "WORK SHIRT", "WORKWEAR", "SHIRT"],
    "t-shirt": ["T-SHIRT", "T SHIRTS", "T-SHIRTS", "SHIRT"],
    "polo": ["POLO SHIRT", "POLOS"],
    "baseball cap": ["BASEBALL CAPS", "BASEBALL CAP", "CAP"],
    "trucker cap": ["TRUCKER CAPS", "CAP"],
    "bottoms": ["PANTS", "BOTTOMS"],
    "tank top": ["TANK TOP"], "wind shirt": ["WIND SHIRT"], "vest": ["VEST"], "body warmer": ["BODY WARMER"], "blazer": ["BLAZER"],
    "beanie": ["BEANIE"], "visors": ["VISORS"], "brim hat": ["BRIM HAT"], "shorts": ["SHORTS"], "leggings": ["LEGGINGS"],
    "baby hat": ["BABY HAT"], "headband": ["HEADBAND"], "track": ["TRACK"], "fashion": ["FASHION"],
}
TYPE_REJECTED = [("SHIRT", "T-SHIRTS")]

# fixed values: decoration technologies
TECHNOLOGY_GROUPS = {
    "screen print": ["SCREEN PRINTING", "SINGLE COLOR", "SINGLE COLOR PRINT"],
    "direct to garment": ["COLOR PRINT", "FULL COLOR TRANSFER", "DIRECT GARMENT PRINT", "FULL COLOR PRINT", "FULL COLOR"],
    "heat transfer": ["HEAT TRANSFER"], "embroidery": ["EMBROIDERY"], "sublimation": ["SUBLIMATION", "DYE SUBLIMATION"],
    "digital": ["DIGITAL", "DIGITAL PRINTING"], "promo": ["PROMOV3"], "pad": ["PAD PRINTING"], "engraving": ["ENGRAVING"],
}

# fixed values: decoration locations
LOCATION_GROUPS = {
    "back": [
        "BACK", "FULL BACK", "CAP BACK", "CENTERED ON BACK", "ON BACK", "CENTRE BACK PANEL", "FRONT AND BACK", "BACK SIDE",
        "BACK, IMPACT UPPER BACK", "IMPACT UPPER BACK", "BACK CENTRE", "LEFT CHEST + BACK",
        "BACK YOKE,  HORIZONTAL, CENTERED ON YOKE", "BACK,  HORIZONTAL, CENTERED ON BACK",
    ],
    "front": [
        "CENTERED ON FRONT", "FRONT", "FULL CHEST", "FULL FRONT", "ON FRONT", "FRONT-CENTRAL", "FRONT HAT", "FRONT PANEL",
        "FRONT PANEL,  CENTER OF DECO AREA 9 CM FROM SIDE SEAM AND 5 CM FROM BOTTOM EDGE", "CENTER FRONT", "CUFFED CENTER FRONT",
        "FRONT, CENTERED", "FRONT CENTER", "FRONT, CENTERED ON UPPER PANEL", "FULL FRONT ONLY", "FULL-FRONT",
        "CAP,  SIDE OPPOSITE FF LONG SEAM, ON DOUBLE FOLDED EDGE", "FRONT/CENTERED", "FRONT AND BACK", "CENTRE FRONT",
        "FRONT CHEST", "FRONT BOTTOM",
        "CENTERED ONN CAP FRONT,  CENTER OF DECORATION AREA 4.5 CM ABOVE LOWER FRONT PANEL SEAM.",
        "ON FRONT,  CENTER OF DECO AREA 4.5 CM ABOVE SEAM AND 6.5 FROM SIDE SEAM", "FRONT CENTRE",
        "CHEST,  HORIZONTAL, CENTERED ON FRONT ACROSS CHEST BELOW PLACKET",
    ],
    "left": [
        "CENTERED ON LEFT CHEST", "LEFT CHEST", "CENTERED ON POCKET", "LC", "CENTERED ON LOWER LEFT LEG", "ON LEFT THIGH", "LEFT",
        "CAP LEFT", "LEFT LEG", "ON LEFT LEG", "CENTERED ON UPPER LEFT LEG (OFF TO THE RIGHT)",
        "CENTERED UPPER LEFT LEG 100MM UNDER THE SEAM", "CENTERED ON LEFT THIGH", "LEFT HIP",
        "THIGH VERTICAL,  CENTERED ON LEFT THIGH", "LEFT LEG / ON TOP NEAR POCKET", "THIGH VERTICAL / CENTERED ON LEFT THIGH",
        "CENTERED ON LEFT LEG POCKET", "CENTERED LEFT BETWEEN STRIPES", "CHEST,  HORIZONTAL, CENTERED ON LEFT CHEST",
        "ON LEFT LEG,  CENTER OF DECO AREA 10 CM BELOW POCKET LIMIT", "LEFT PANEL, CENTERED", "ON SIDE",
        "CENTERED ON LEFT LOWER POCKET,  UNDER BELT", "ON POCKET", "LEFT CHEST + SLEEVES",
        "LEFT LEG,  CENTERED ON TOP NEAR POCKET", "CENTERED UPPER LEFT LEG", "POCKET FONT", "TOP LEFT LEG",
        "CENTERED ON  LEFT LEG POCKET,  CENTER OF DECO AREA  87MM  ABOVE POCKET BOTTOM",
        "CENTERED ON CUFF,  CENTER OF DECO AREA 3, 5 CM FROM UPPER CUFF EDGE AND 10 CM FROM SIDE CUFF EDGE",
        "CENTERED ABOVE POCKET,  DECO AREA STARTS 2CM ABOVE POCKET", "CENTERED ON LEFT CHEST ABOVE POCKET", "BOTTOM LEFT LEG",
        "NEAR LEFT LEG POCKET", "LEFT CHEST + BACK", "POCKET FRONT", "CHEST,  CENTRED ON LEFT CHEST", "UPPER LEFT LEG",
    ],
    "right": [
        "RIGHT CHEST", "CENTERED ON POCKET", "CENTERED ON RIGHT CHEST", "RIGHT FRONT ABOVE SEAM", "RIGHT FRONT ABOVE SEAM (SLANTED)",
        "RIGHT YOKE", "RIGHT SLEEVE", "CENTERED ON RIGHT PANEL", "FRONT CENTERED RIGHT LEG",
        "CENTERED ON STRAP / SIDE OPPOSITE OF LONG SEAM,  LOGO ELEVATE ON RIGHT SIDE", "CENTERED ON RIGHT LEG",
        "RIGHT LEG SIDE POCKET", "ON SIDE", "ON POCKET", "POCKET FONT",
        "CENTERED ON CUFF,  CENTER OF DECO AREA 3, 5 CM FROM UPPER CUFF EDGE AND 10 CM FROM SIDE CUFF EDGE",
        "SIDE OPPOSITE OF LONG SEAM,  LOGO ''ELEVATE'' ON RIGHT SIDE, ON BODY", "POCKET FRONT",
    ],
}
# fixed values: sources that accept other groups than their own
LOCATION_ACCEPTS = {
    "FRONT CHEST": ["left"],
    "EMBROIDERY": ["back", "front", "left", "right"],
    "CHEST,  HORIZONTAL,  - CENTERED ON LEFT CHEST": ["left"],
    "SIDE OPPOSITE OF LONG SEAM,  LOGO ''ELEVATE'' ON RIGHT SIDE ,ON BODY": ["right"],
}

# fixed values: sleeve styles, genders, fits
SLEEVE_GROUPS = {
    "half": ["3/4 SLEEVE", "HALF SLEEVE"], "long": ["LONG SLEEVE"], "short": ["SHORT SLEEVE"],
    "none": ["SLEEVELESS", "SLEEVLESS"], "abc": ["ABC"],
}
GENDERS = ["MEN", "MEN OR WOMEN", "WOMEN", "YOUTH", "BABY"]
FITS = ["ADJUSTABLE", "STRETCH FIT", "ONE SIZE", "FITTED", "REGULAR FIT"]


@dataclass(frozen=True)
class Vocabulary:
    """Groups of values; ``accepts`` overrides what a source accepts, ``rejected`` lists excluded pairs."""

    groups: dict[str, list[str]]
    accepts: dict[str, list[str]] = field(default_factory=dict)
    rejected: list[tuple[str, str]] = field(default_factory=list)

    def membership(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for group, values in self.groups.items():
            for value in values:
                out.setdefault(value, []).append(group)
        return out

    def accepted(self) -> dict[str, list[str]]:
        return {**self.membership(), **self.accepts}

    def values(self) -> list[str]:
        return list(dict.fromkeys([*self.membership(), *self.accepts]))

    def agrees(self, source: Column, target: Column) -> Column:
        """1 or 0; null when a value is missing or undefined."""
        s, t = F.upper(source), F.upper(target)
        accepted = F.try_element_at(literal_map(self.accepted()), s)
        member = F.try_element_at(literal_map({v: self.membership().get(v, []) for v in self.values()}), t)
        hit = F.arrays_overlap(accepted, member)
        for a, b in self.rejected:
            hit = hit & ~((s == a) & (t == b))
        return F.when(accepted.isNotNull() & member.isNotNull(), F.coalesce(hit, F.lit(False)).cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(table: dict[str, list[str]]) -> Column:
    """Constant map as one SQL text: one expression to build instead of one per entry."""
    entries = [f"{sql_text(k)}, cast(array({', '.join(map(sql_text, v))}) as array<string>)" for k, v in table.items()]
    return F.expr(f"map({', '.join(entries)})")


class _Words(Vocabulary):
    """Values agree when they share a word."""

    def agrees(self, source: Column, target: Column) -> Column:
        s, t = F.upper(source), F.upper(target)
        defined = s.isin(self.values()) & t.isin(self.values())
        return F.when(defined, F.arrays_overlap(F.split(s, r"\s+"), F.split(t, r"\s+")).cast("int"))


VOCABULARIES: dict[str, Vocabulary] = {
    "gender": _Words({g: [g] for g in GENDERS}),
    "type": Vocabulary(TYPE_GROUPS, rejected=TYPE_REJECTED),
    "decoration_technology": Vocabulary(TECHNOLOGY_GROUPS),
    "decoration_location": Vocabulary(LOCATION_GROUPS, LOCATION_ACCEPTS),
    "sleeve_style": Vocabulary(SLEEVE_GROUPS),
    "fit_type": Vocabulary({f: [f] for f in FITS}),
}


def is_relevant(product_group: Column, attribute: str, relevant: dict[str, list[str]]) -> Column:
    return product_group.isin([g for g, attrs in relevant.items() if attribute in attrs])
