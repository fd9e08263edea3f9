"""Invented documents: a clean set that publishes, and a broken set with one fault per rule."""

from pathlib import Path

CLEAN = {
    "manufacturers/aurora-labs.yaml": """
id: m-aurora
name: Aurora Labs
companyName: Aurora Labs GmbH
website: https://aurora.example
description: Makes *things*.
searchTerms: [aurora, al]
translations:
  de:
    description: Baut Dinge.
  it:
    description: Non approvato.
""",
    "manufacturers/borealis.yaml": """
id: m-borealis
name: Borealis
parentCompany: aurora-labs
website: https://borealis.example
""",
    "manufacturers/cirrus.yml": """
id: m-cirrus
name: Cirrus
parentCompany: nobody
""",
    "software/glow.yaml": """
id: s-glow
name: Glow
manufacturer: aurora-labs
primaryCategory: synthesizer
categories: [fx, effect, plugin]
formats: [vst3, au, standalone, aax]
platforms: [mac, windows]
identifiers:
  vst3: com.aurora.Glow
  aax: toolong
  bundle: com.aurora.Glow
website: https://aurora.example/glow
releaseDate: 2001-05-06
description: A synthesizer with glowing oscillators.
details:
  - First paragraph.
  - Second paragraph.
versions:
  - name: "1.0"
    preRelease: true
    url: https://aurora.example/glow/1
  - name: "2.0"
prices:
  - amount: 99
    currency: EUR
    asOf: 2024-01-01
    source: https://shop.example/glow
  - amount: 89.5
    currency: USD
links:
  - type: video
    url: https://www.youtube.com/watch?v=abc-123
translations:
  de:
    description: Ein Synthesizer.
    links:
      - type: page
        url: https://aurora.example/de/glow
  fr:
    links:
      - type: page
        title: Seulement des liens
  es:
    description: ""
verification:
  lastVerified: 2023-12-01
  status: active
""",
    "software/glow-classic.yaml": """
id: s-classic
name: Glow Classic
manufacturer: nobody-known
supersedes: s-glow
formats: [vst2]
verification:
  lastVerified: 2023-01-01
  status: discontinued
""",
    "software/shimmer.yaml": """
id: s-shimmer
name: Shimmer
manufacturer: borealis
categories: [equalizer]
""",
    "hardware/beacon.yaml": """
id: h-beacon
name: Beacon
manufacturer: borealis
primaryCategory: eq
releaseDate: "1999"
releaseDateYearOnly: true
io:
  - {name: OUT, signalFlow: output, category: audio, type: line, connection: 1/4-inch}
  - {name: OUT, signalFlow: output, category: audio, type: line, connection: xlr, maxConnections: 2}
  - {name: IN, signalFlow: input, category: audio, type: line, connection: 1/4-inch}
revisions:
  - name: mk1
  - name: mk2
    releaseDate: "2005"
    releaseDateYearOnly: true
    io:
      - {name: USB, signalFlow: bidirectional, category: data, type: usb, connection: usb-b}
    versions:
      - name: "1.1"
        unofficial: true
    prices:
      - {amount: 10, currency: EUR}
    links:
      - {type: manual, url: https://borealis.example/mk2.pdf}
translations:
  de:
    specs: Technische Daten
    io:
      - {originalName: OUT, name: AUSGANG}
      - {originalName: NOPE, name: FALSCH}
""",
}

BROKEN = {
    "manufacturers/owner-one.yaml": "id: o1\nname: Owner One\n",
    "manufacturers/owner-two.yaml": "id: o1\nname: ''\nsearchTerms: word\n",
    "manufacturers/unreadable.yaml": "name: [unclosed\nid: x\n",
    "manufacturers/twice.yaml": "name: A\nname: B\n",
    "manufacturers/list.yaml": "- a\n- b\n",
    "software/bad-owner.yaml": "id: s1\nname: X\nmanufacturer: owner-onne\ncategories: [plugin, plugin, plugin]\n",
    "software/bad-words.yaml": """
id: s2
name: X
manufacturer: owner-one
primaryCategory: PLUGINS
categories: [curl, abcdefgh]
formats: [vst4, zzzzzzzz]
platforms: [amiga]
""",
    "software/bad-lineage.yaml": "id: s3\nname: X\nmanufacturer: owner-one\nsupersedes: h1\n",
    "software/bad-list.yaml": """
id: s4
name: X
manufacturer: owner-one
primaryCategory: plugin
secondaryCategory: effect
categories: [plugin, effect, daw, daw, daw]
""",
    "software/bad-urls.yaml": """
id: s5
name: X
manufacturer: owner-one
website: not a url
links:
  - {type: v, url: "https://youtube.com/watch?v=1"}
  - {type: v, url: "https://m.youtube.com/watch?v=1"}
  - {type: v, url: "https://youtu.be/1"}
  - {type: v, url: "https://www.youtube.com/embed/1"}
  - {type: v, url: "https://www.youtube.com/watch?v=1&t=2"}
  - {type: v, url: "https://www.youtube.com/watch?v=1"}
  - {title: no type}
  - just text
""",
    "software/bad-dates.yaml": """
id: s6
name: X
manufacturer: owner-one
releaseDate: 2001-02-03
releaseDateYearOnly: true
versions:
  - {name: "1", releaseDateYearOnly: true}
prices:
  - {amount: many, currency: EUR, asOf: 2023-02-30}
""",
    "software/bad-text.yaml": """
id: s7
name: X
manufacturer: owner-one
description: |
  ```
  never `closed
details: |
  fine
  odd ` here
  ```js
  odd ` inside a fence
  ```
  odd ` again
""",
    "software/ring-a.yaml": "id: ra\nname: A\nmanufacturer: owner-one\nsupersedes: rb\n",
    "software/ring-b.yaml": "id: rb\nname: B\nmanufacturer: owner-one\nsupersedes: rc\n",
    "software/ring-c.yaml": "id: rc\nname: C\nmanufacturer: owner-one\nsupersedes: ra\n",
    "software/ring-tail.yaml": "id: rt\nname: T\nmanufacturer: owner-one\nsupersedes: rb\n",
    "software/ring-self.yaml": "id: rs\nname: S\nmanufacturer: owner-one\nsupersedes: rs\n",
    "software/two-names.yaml": "id: s8\nname: X\nmanufacturer: owner-one\ncategories: [fx, effect]\n",
    "software/fine.yaml": "id: s9\nname: X\nmanufacturer: owner-one\ncategories: [plugin, eq]\n",
    "software/same-id.yaml": "id: s9\nname: Y\nmanufacturer: owner-one\n",
    "software/same-id-too.yaml": "id: s9\nname: Z\nmanufacturer: owner-one\n",
    "software/number-id.yaml": "id: 12\nname: X\nmanufacturer: owner-one\n",
    "software/no-id.yaml": "name: X\nmanufacturer: owner-one\n",
    "hardware/no-owner.yaml": "id: h1\nname: X\n",
    "hardware/bad-translation.yaml": """
id: h2
name: X
manufacturer: owner-one
io:
  - {name: OUT, signalFlow: output, category: audio, type: line, connection: xlr}
translations:
  it: {description: x}
  de:
    title: unknown field
    io:
      - {originalName: OUT, name: AUS}
      - {originalName: IN, name: EIN}
      - {name: ohne}
""",
}

CATEGORIES = ("plugin", "effect", "synthesizer", "equalizer", "daw", "headphones", "pitch-shifter")


def write(documents: dict[str, str], root: Path) -> str:
    for name, body in documents.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(body.lstrip("\n"), encoding="utf-8")
    return str(root)
