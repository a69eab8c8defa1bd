"""Register records as XML text."""

from __future__ import annotations


def ring(positions: str) -> str:
    return f'<gml:LinearRing><gml:posList count="4">{positions}</gml:posList></gml:LinearRing>'


def polygon(outer: str, *inner: str, dimension: int | None = 3) -> str:
    declared = f' srsDimension="{dimension}"' if dimension else ""
    holes = "".join(f"<gml:interior>{ring(i)}</gml:interior>" for i in inner)
    return (
        f'<gml:Polygon srsName="x"{declared}><gml:exterior>{ring(outer)}</gml:exterior>'
        f"{holes}</gml:Polygon>"
    )


def vlak(*args, **kwargs) -> str:
    return f"<Objecten:vlak>{polygon(*args, **kwargs)}</Objecten:vlak>"


def punt(text: str) -> str:
    return f'<Objecten:punt><gml:Point srsName="x"><gml:pos>{text}</gml:pos></gml:Point></Objecten:punt>'


def multivlak(*polygons: str) -> str:
    members = "".join(f"<gml:surfaceMember>{p}</gml:surfaceMember>" for p in polygons)
    return f"<Objecten:multivlak><gml:MultiSurface>{members}</gml:MultiSurface></Objecten:multivlak>"


def record(kind: str, key: str, geometry: str | None = None, version: int = 1, more: str = "") -> str:
    shape = f"<Objecten:geometrie>{geometry}</Objecten:geometrie>" if geometry is not None else ""
    return f"""<sl-bag-extract:bagObject><Objecten:{kind}>
      <Objecten:identificatie domein="NL.IMBAG.{kind}">{key}</Objecten:identificatie>
      {shape}{more}
      <Objecten:voorkomen><Historie:Voorkomen>
        <Historie:voorkomenidentificatie>{version}</Historie:voorkomenidentificatie>
      </Historie:Voorkomen></Objecten:voorkomen>
    </Objecten:{kind}></sl-bag-extract:bagObject>"""


def document(*records: str) -> str:
    body = "\n".join(records)
    return f"""<?xml version="1.0" encoding="UTF-8"?>
<sl-bag-extract:bagStand xmlns:sl-bag-extract="urn:a" xmlns:Objecten="urn:b"
  xmlns:gml="urn:c" xmlns:Historie="urn:d"><sl:standBestand xmlns:sl="urn:e">
{body}
</sl:standBestand></sl-bag-extract:bagStand>"""


def to_wgs84(x: float, y: float) -> tuple[float, float]:
    """Independent evaluation of the published polynomial by powers: longitude, latitude."""
    from terravane import constants as K

    dx, dy = (x - 155000) * 1e-5, (y - 463000) * 1e-5
    lat = sum(c * dx**p * dy**q for (p, q), c in K.LAT_TERMS.items())
    long = sum(c * dx**p * dy**q for (p, q), c in K.LONG_TERMS.items())
    return 5.38720621 + long / 3600, 52.15517440 + lat / 3600


def numbers_of(wkt: str) -> list[list[list[tuple[float, float]]]]:
    """Members, rings and points of a WKT text."""
    import re

    kind, body = wkt.split(" ", 1)
    if kind == "POINT":
        body = f"(({body}))"
    elif kind == "POLYGON":
        body = f"({body})"
    members = re.findall(r"\(\(.*?\)\)", body[1:-1])
    return [
        [
            [tuple(map(float, p.split())) for p in r.split(", ")]
            for r in re.findall(r"\(([^()]*)\)", m)
        ]
        for m in members
    ]
