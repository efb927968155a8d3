"""Colour science as Column expressions: hex -> CIE Lab (D65), CMC 2:1 difference, nearest names."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from affinora.functions.binding import let

# fixed values: sRGB to XYZ matrix, D65 white point, CIE constants, CMC l:c = 2:1
SRGB_TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE_D65 = (0.95047, 1.0, 1.08883)
CIE_EPSILON = 216.0 / 24389.0
CIE_KAPPA = 24389.0 / 27.0
CMC_LIGHTNESS = 2.0
CMC_CHROMA = 1.0

# fixed values: anchors of the basic colour names
BASIC_COLORS = {
    "blue": ["#0000FF", "#000080", "#4682B4", "#5F9EA0", "#1E3F66", "#87CEEB"],
    "purple": ["#800080", "#9370DB", "#BA55D3"],
    "red": ["#FF0000", "#DC143C", "#B22222", "#FF6347", "#C41E3A"],
    "brown": ["#A52A2A", "#8B4513", "#D2691E", "#654321", "#7B3F00"],
    "gray": ["#808080", "#A9A9A9", "#D3D3D3"],
    "pink": ["#FFC0CB", "#FFB6C1", "#FADADD", "#F5E6E8", "#FFE4E1"],
    "green": ["#008000", "#00FF00", "#006400", "#9ACD32", "#98FB98"],
    "orange": ["#FFA500", "#FF8C00", "#FFB347"],
    "yellow": ["#FFFF00", "#FFD700", "#FFFACD"],
    "white": ["#FFFFFF", "#F5F5F5"],
    "black": ["#000000"],
}

# fixed values: CSS3 colour keywords (one name per distinct colour)
CSS_COLORS = {
    "aliceblue": "#f0f8ff", "antiquewhite": "#faebd7", "aqua": "#00ffff", "aquamarine": "#7fffd4", "azure": "#f0ffff",
    "beige": "#f5f5dc", "bisque": "#ffe4c4", "black": "#000000", "blanchedalmond": "#ffebcd", "blue": "#0000ff",
    "blueviolet": "#8a2be2", "brown": "#a52a2a", "burlywood": "#deb887", "cadetblue": "#5f9ea0", "chartreuse": "#7fff00",
    "chocolate": "#d2691e", "coral": "#ff7f50", "cornflowerblue": "#6495ed", "cornsilk": "#fff8dc", "crimson": "#dc143c",
    "darkblue": "#00008b", "darkcyan": "#008b8b", "darkgoldenrod": "#b8860b", "darkgray": "#a9a9a9", "darkgreen": "#006400",
    "darkkhaki": "#bdb76b", "darkmagenta": "#8b008b", "darkolivegreen": "#556b2f", "darkorange": "#ff8c00",
    "darkorchid": "#9932cc", "darkred": "#8b0000", "darksalmon": "#e9967a", "darkseagreen": "#8fbc8f",
    "darkslateblue": "#483d8b", "darkslategray": "#2f4f4f", "darkturquoise": "#00ced1", "darkviolet": "#9400d3",
    "deeppink": "#ff1493", "deepskyblue": "#00bfff", "dimgray": "#696969", "dodgerblue": "#1e90ff", "firebrick": "#b22222",
    "floralwhite": "#fffaf0", "forestgreen": "#228b22", "fuchsia": "#ff00ff", "gainsboro": "#dcdcdc", "ghostwhite": "#f8f8ff",
    "gold": "#ffd700", "goldenrod": "#daa520", "gray": "#808080", "green": "#008000", "greenyellow": "#adff2f",
    "honeydew": "#f0fff0", "hotpink": "#ff69b4", "indianred": "#cd5c5c", "indigo": "#4b0082", "ivory": "#fffff0",
    "khaki": "#f0e68c", "lavender": "#e6e6fa", "lavenderblush": "#fff0f5", "lawngreen": "#7cfc00", "lemonchiffon": "#fffacd",
    "lightblue": "#add8e6", "lightcoral": "#f08080", "lightcyan": "#e0ffff", "lightgoldenrodyellow": "#fafad2",
    "lightgray": "#d3d3d3", "lightgreen": "#90ee90", "lightpink": "#ffb6c1", "lightsalmon": "#ffa07a",
    "lightseagreen": "#20b2aa", "lightskyblue": "#87cefa", "lightslategray": "#778899", "lightsteelblue": "#b0c4de",
    "lightyellow": "#ffffe0", "lime": "#00ff00", "limegreen": "#32cd32", "linen": "#faf0e6", "maroon": "#800000",
    "mediumaquamarine": "#66cdaa", "mediumblue": "#0000cd", "mediumorchid": "#ba55d3", "mediumpurple": "#9370db",
    "mediumseagreen": "#3cb371", "mediumslateblue": "#7b68ee", "mediumspringgreen": "#00fa9a", "mediumturquoise": "#48d1cc",
    "mediumvioletred": "#c71585", "midnightblue": "#191970", "mintcream": "#f5fffa", "mistyrose": "#ffe4e1",
    "moccasin": "#ffe4b5", "navajowhite": "#ffdead", "navy": "#000080", "oldlace": "#fdf5e6", "olive": "#808000",
    "olivedrab": "#6b8e23", "orange": "#ffa500", "orangered": "#ff4500", "orchid": "#da70d6", "palegoldenrod": "#eee8aa",
    "palegreen": "#98fb98", "paleturquoise": "#afeeee", "palevioletred": "#db7093", "papayawhip": "#ffefd5",
    "peachpuff": "#ffdab9", "peru": "#cd853f", "pink": "#ffc0cb", "plum": "#dda0dd", "powderblue": "#b0e0e6",
    "purple": "#800080", "red": "#ff0000", "rosybrown": "#bc8f8f", "royalblue": "#4169e1", "saddlebrown": "#8b4513",
    "salmon": "#fa8072", "sandybrown": "#f4a460", "seagreen": "#2e8b57", "seashell": "#fff5ee", "sienna": "#a0522d",
    "silver": "#c0c0c0", "skyblue": "#87ceeb", "slateblue": "#6a5acd", "slategray": "#708090", "snow": "#fffafa",
    "springgreen": "#00ff7f", "steelblue": "#4682b4", "tan": "#d2b48c", "teal": "#008080", "thistle": "#d8bfd8",
    "tomato": "#ff6347", "turquoise": "#40e0d0", "violet": "#ee82ee", "wheat": "#f5deb3", "white": "#ffffff",
    "whitesmoke": "#f5f5f5", "yellow": "#ffff00", "yellowgreen": "#9acd32",
}


def channel(hex_color: Column, index: int) -> Column:
    """0-255 value of a channel of ``#RRGGBB``."""
    return F.conv(F.substring(hex_color, 2 + 2 * index, 2), 16, 10).cast("int")


def hex_to_lab(hex_color: Column) -> Column:
    """Struct (l, a, b)."""

    def linear(index: int) -> Column:
        v = channel(hex_color, index) / 255.0
        return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))

    rgb = [linear(i) for i in range(3)]

    def f(row: int) -> Column:
        m = SRGB_TO_XYZ[row]
        t = (rgb[0] * m[0] + rgb[1] * m[1] + rgb[2] * m[2]) / WHITE_D65[row]
        return F.when(t > CIE_EPSILON, F.pow(t, F.lit(1.0 / 3.0))).otherwise((t * CIE_KAPPA + 16.0) / 116.0)

    return F.struct(
        (f(1) * 116.0 - 16.0).alias("l"), ((f(0) - f(1)) * 500.0).alias("a"), ((f(1) - f(2)) * 200.0).alias("b")
    )


def lab_of(hex_color: str) -> tuple[float, float, float]:
    """Lab of one constant colour, for literals."""
    rgb = [int(hex_color[i : i + 2], 16) / 255.0 for i in (1, 3, 5)]
    lin = [v / 12.92 if v <= 0.04045 else ((v + 0.055) / 1.055) ** 2.4 for v in rgb]
    xyz = [sum(m * v for m, v in zip(row, lin)) / w for row, w in zip(SRGB_TO_XYZ, WHITE_D65)]
    fx, fy, fz = [t ** (1 / 3) if t > CIE_EPSILON else (t * CIE_KAPPA + 16) / 116 for t in xyz]
    return 116 * fy - 16, 500 * (fx - fy), 200 * (fy - fz)


def cmc_standard(lab: Column) -> Column:
    """Everything the CMC difference needs of the standard colour, computed once."""
    l, a, b = lab["l"], lab["a"], lab["b"]

    def of_chroma(c: Column) -> Column:
        angle = F.degrees(F.atan2(b, a))
        hue = F.when(angle < 0, angle + 360.0).otherwise(angle)

        def of_hue(h: Column) -> Column:
            t = F.when(h.between(164.0, 345.0), F.abs(F.cos(F.radians(h + 168.0)) * 0.2) + 0.56).otherwise(
                F.abs(F.cos(F.radians(h + 35.0)) * 0.4) + 0.36
            )
            c4 = F.pow(c, F.lit(4.0))
            f = F.sqrt(c4 / (c4 + 1900.0))
            sl = F.when(l < 16.0, F.lit(0.511)).otherwise(l * 0.040975 / (l * 0.01765 + 1.0))
            sc = c * 0.0638 / (c * 0.0131 + 1.0) + 0.638
            return F.struct(
                l.alias("l"), a.alias("a"), b.alias("b"), c.alias("c"), (sl * CMC_LIGHTNESS).alias("sl"),
                (sc * CMC_CHROMA).alias("sc"), (sc * (f * t + 1.0 - f)).alias("sh"),
            )

        return let(hue, of_hue)

    return let(F.sqrt(a * a + b * b), of_chroma)


def cmc_distance(standard: Column, sample: Column) -> Column:
    """CMC(2:1) difference of a prepared standard and a Lab struct."""
    da, db = standard["a"] - sample["a"], standard["b"] - sample["b"]
    dl = standard["l"] - sample["l"]
    dc = standard["c"] - F.sqrt(sample["a"] * sample["a"] + sample["b"] * sample["b"])
    dh2 = F.greatest(da * da + db * db - dc * dc, F.lit(0.0))
    x, y = dl / standard["sl"], dc / standard["sc"]
    return F.sqrt(x * x + y * y + dh2 / (standard["sh"] * standard["sh"]))


def delta_e_cmc(first: Column, second: Column) -> Column:
    """CMC(2:1) difference of two Lab structs; the first is the standard."""
    return let(cmc_standard(first), lambda s: cmc_distance(s, second))


def color_similarity(first_lab: Column, second_lab: Column) -> Column:
    """1 for equal colours, falling by 0.01 per unit of difference."""
    return 1.0 - delta_e_cmc(first_lab, second_lab) / 100.0


def nearest_basic_color(lab: Column) -> Column:
    """Name of the nearest anchor; the earlier anchor wins a tie."""
    codes = [(name, lab_of(code)) for name, codes in BASIC_COLORS.items() for code in codes]
    anchors = F.expr("array(" + ", ".join(
        f"named_struct('pos', {i}, 'name', '{name}', 'l', {l!r}D, 'a', {a!r}D, 'b', {b!r}D)" for i, (name, (l, a, b)) in enumerate(codes)
    ) + ")")

    def nearest(own: Column) -> Column:
        scored = F.transform(anchors, lambda x: F.struct(cmc_distance(own, x).alias("d"), x["pos"].alias("pos"), x["name"].alias("name")))
        return F.array_min(scored)["name"]

    return let(cmc_standard(lab), nearest)


def nearest_css_color(hex_color: Column) -> Column:
    """CSS keyword with the smallest squared RGB distance; the alphabetically first wins a tie."""
    rgb = F.struct(*[channel(hex_color, i).alias(c) for i, c in enumerate("rgb")])
    palette = F.expr("array(" + ", ".join(
        "named_struct('r', {}, 'g', {}, 'b', {}, 'name', '{}')".format(*(int(code[i : i + 2], 16) for i in (1, 3, 5)), name)
        for name, code in CSS_COLORS.items()
    ) + ")")

    def nearest(own: Column) -> Column:
        def distance(x: Column) -> Column:
            gaps = [own[c] - x[c] for c in "rgb"]
            return gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]

        return F.array_min(F.transform(palette, lambda x: F.struct(distance(x).alias("d"), x["name"].alias("name"))))["name"]

    return let(rgb, nearest)
