"""Patterns by which decision texts tell funds, co-financing and technologies."""

# Names of funds in decision texts.
FUNDS = {
    "ERDF": r"european\s+regional\s+development\s+fund|erdf(?=[^a-z])|\befre\b|\bfeder\b",
    "ESF": r"european\s+social\s+fund|esf(?:\+|\s+plus)?(?=[^a-z])|fse(?=[^a-z])|fonds\s+social\s+europ[eé]en",
    "CF": r"cohesion\s+fund|fonds\s+de\s+coh[eé]sion|koh[aä]sionsfonds",
    "JTF": r"just\s+transition\s+fund|jtf(?=[^a-z])|fonds\s+pour\s+une\s+transition\s+juste|fonds\s+f[uü]r\s+einen\s+gerechten\s+[Üü]bergang",
    "RRF": r"recovery\s+and\s+resilience\s+facility|rrf(?=[^a-z])|facilit[eé]\s+pour\s+la\s+reprise\s+et\s+la\s+r[eé]silience|aufbau-?\s+und\s+resilienzfazilität",
    "ESIF": r"european\s+structural\s+and\s+investment\s+fund|esif(?=[^a-z])|structural\s+and\s+investment\s+funds?|fonds\s+structurels",
    "INTERREG": r"\binterreg\b",
    "EAFRD": r"european\s+agricultural\s+fund\s+for\s+rural\s+development|eafrd(?=[^a-z])|\bfeader\b",
    "EAGF": r"european\s+agricultural\s+guarantee\s+fund|eagf(?=[^a-z])|\bfeaga\b",
    "EMFAF": r"european\s+maritime,?\s+fisheries\s+and\s+aquaculture\s+fund|emfaf(?=[^a-z])|european\s+maritime\s+and\s+fisheries\s+fund|emff(?=[^a-z])",
    "INNOVFUND": r"(?:eu\s+)?innovation\s+fund(?:\s+for)?|innovfund(?=[^a-z])|innovation\s+fund\s+\(if\)",
    "CEF": r"connecting\s+europe\s+facilit(?:y|é)|cef(?=[^a-z])",
    "LIFE": r"\blife\+\b|programme\s+for\s+the\s+environment\s+and\s+climate\s+action|life\s+programme(?=[^a-z])",
    "HORIZON": r"horizon\s+(?:2020|europe)|h2020(?=[^a-z])",
}

# Wordings that confirm co-financing, in the order in which they are tried.
CONFIRMED = [
    r"Co-financing\s+by\s+(?:a|the)\s+Union\s+fund",
    r"(?:will\s+be\s+using|seeking|plans?\s+to\s+seek|intends?\s+to\s+seek)\s+co.?financ\w*\s+from\s+the\s+(?:european|erdf|esf|cohesion|jtf|rrf|structural)",
    r"(?:will\s+be\s+|shall\s+be\s+|is\s+)?(?:funded|financed)\s+(?:by|through)\s+the\s+(?:recovery\s+and\s+resilience\s+facility|rrf[^a-zA-Z])",
    r"totally\s+made\s+available\s+(?:through|by)\s+the\s+(?:recovery\s+and\s+resilience|rrf[^a-zA-Z])",
    r"(?:is|are|shall\s+be|will\s+be)\s+(?:partly\s+|fully\s+|entirely\s+)?co.?financ\w+\s+(?:by|from)\s+the\s+"
    r"(?:european|recovery\s+and\s+resilience|erdf|esf[^a-z]|cohesion\s+fund|just\s+transition|jtf[^a-z]|rrf[^a-z]|esif[^a-z]|structural)",
    r"co.?financ\w+\s+with(?:\s+\S+){1,15}\s+(?:recovery\s+and\s+resilience|rrf[^a-zA-Z])",
    r"partly\s+co.?financ\w+\s+from\s+the\s+(?:european|erdf|esf[^a-z]|cohesion|jtf|rrf)",
    r"(?:funded|financed|supported)\s+(?:by|through|via|from)\s+the\s+(?:erdf[^a-z]|esf[^a-z]|cohesion\s+fund|just\s+transition\s+fund|jtf[^a-z]|"
    r"european\s+regional\s+development|european\s+social\s+fund|european\s+agricultural\s+fund|eafrd[^a-z])",
    r"(?:grant|contribution|payment|financing)\s+(?:of\s+|from\s+)?the\s+(?:erdf[^a-z]|esf[^a-z]|cohesion\s+fund|just\s+transition\s+fund|jtf[^a-z]|european\s+regional|european\s+social\s+fund|eafrd[^a-z])",
]

# Wordings that only allow for co-financing.
CONDITIONAL = [
    r"to\s+the\s+extent\s+(?:the\s+)?(?:scheme\s+)?(?:is\s+)?co.?financ",
    r"does\s+not\s+exclude\s+that.{0,150}?(?:esif|erdf|esf|structural\s+fund|cohesion)",
    r"may\s+be\s+co.?financ\w+\s+by\s+(?:the\s+)?(?:european|esif|erdf|structural)",
    r"in\s+the\s+event\s+of\s+co.?financ",
    r"consider(?:ing)?\s+(?:to\s+)?(?:seek(?:ing)?|apply(?:ing)?\s+for)\s+co.?financ",
    r"intend(?:s|ing)?\s+to\s+(?:partly\s+)?financ\w+\s+(?:through|via|with|from)\s+(?:the\s+)?(?:recovery\s+and\s+resilience|rrf[^a-z])",
]

# Wordings that every decision has and that say nothing.
BOILERPLATE = [
    r"financ\w+\s+entirely\s+from\s+state\s+resources\s+or\s+partly\s+financ\w+\s+by\s+the\s+union",
    r"financ\w+\s+through\s+state\s+resources",
    r"to\s+the\s+extent\s+(?:that\s+)?(?:the\s+)?(?:scheme\s+)?(?:is\s+)?co.?financ\w+\s+by[^.]{0,600}\.",
    r"(?:does\s+not\s+exclude\s+that[^.]{0,200}\.)",
    r"partly\s+financ\w+\s+by\s+the\s+(?:union|esif[^a-z])",
    r"this\s+text\s+is\s+made\s+available\s+for\s+information\s+purposes\s+only",
    r"only\s+the\s+\w+\s+text\s+is\s+(?:authentic|available\s+and\s+authentic)",
    r"seul\s+le\s+texte\s+.{0,30}?\s+fait\s+foi",
    r"Brussels,?\s+\d{1,2}[\s\./\\]+[\w\s\.]+\d{4}",
    r"SG\s*[\(\[]\s*\d{4}\s*[\)\]]\s*[\dA-Z/]+",
    r"C\s*\(\s*\d{4}\s*\)\s*\d+\s*(?:final)?",
    r"does\s+not\s+constitute\s+an\s+official\s+publication",
]

# The notification form's row of funds and amounts, and what its acronyms stand for.
FORM_ANCHOR = r"if\s+co-?financ\w*\s+by\s+community\s+funds?"
FORM_ROW = r"\b(FEAGA|FEDER|Feader|ERDF|EFRE|FSE|ESF[+\+]?|JTF|CF|RRF|INTERREG|EAFRD|FEADER)\b\s*[-–:]\s*([\d\s\.\,]+)\s*EUR"
FORM_FUNDS = {"FEAGA": "EAGF", "FEDER": "ERDF", "FEADER": "EAFRD", "EFRE": "ERDF", "FSE": "ESF"}

# Headings of sections about funds, and words near which an excerpt is taken.
SECTION_HEADING = (
    r"^#{1,4}\s+(?:.*?)(?:union\s+fund|european\s+(?:regional|social|structural|agricultural)|erdf|esf[^a-z]|cohesion\s+fund|just\s+transition\s+fund|jtf[^a-z]|rrf[^a-z]|esif[^a-z]|structural\s+(?:fund|investment))"
)
EXCERPT_WORDS = (
    r"co.?financ|funded\s+by|financed\s+by|financed\s+through|erdf|esf[^a-z]|cohesion\s+fund|just\s+transition|recovery\s+and\s+resilience|rrf[^a-z]|eafrd|eagf|feder\b|feader\b|feaga\b"
)

# Technologies by strong and moderate words.
TECHNOLOGIES = {
    "wind": {
        "strong": [
            r"\bwind\s*(energy|power|farm|turbine|park|offshore|onshore)\b", r"\boffshore\s+wind\b", r"\bonshore\s+wind\b", r"\bwind\s+generation\b", r"\bwindenergie\b", r"\bwindkraft(?:anlage)?\b", r"\bwindpark\b",
            r"\b[eé]olien(?:ne)?s?\b", r"\bparc\s+[eé]olien\b", r"\bparque\s+e[oó]lico\b", r"\benerg[ií]a\s+e[oó]lica\b", r"\bwindmolenpark\b", r"\bvindkraft\b", r"\bvindenergi\b", r"\bvindm[oø]lle\b", r"\btuulivoima\b",
            r"\bfarma?\s+wiatrow[aey]\b", r"\benergi[aą]\s+wiatrow[aą]\b",
        ],
        "moderate": [
            r"\brenewable\s+energy\b", r"\berneuerbare\s+energie\b", r"\b[eé]nergie\s+renouvelable\b", r"\benerg[ií]as?\s+renovable\b", r"\bclean\s+energy\b", r"\bgreen\s+energy\b", r"\belectricity\s+generation\b",
            r"\bvedvarende\s+energi\b",
        ],
    },
    "solar": {
        "strong": [
            r"\bsolar\s*(energy|power|panel|cell|module|photovoltaic|pv)\b", r"\bphotovoltaic\b", r"\b(?:PV|CSP)\s+(plant|module|installation|farm)\b", r"\bsolar\s+(?:farm|park)\b", r"\bsolarenergie\b", r"\bphotovoltaik\b",
            r"\bsolaranlage\b", r"\bsolaire\b", r"\bphotovolta[iï]que\b", r"\bfotovoltaic[ao]?\b", r"\bfotowoltaic\w*\b",
        ],
        "moderate": [r"\brenewable\s+energy\b", r"\berneuerbare\s+energie\b", r"\b[eé]nergie\s+renouvelable\b", r"\bclean\s+energy\b", r"\bgreen\s+energy\b", r"\belectricity\s+generation\b"],
    },
    "hydrogen": {
        "strong": [
            r"\bhydrogen\b", r"\belectrolys(?:er|is|eur)\b", r"\belectrolyzer\b", r"\bfuel\s+cell\b", r"\bgreen\s+hydrogen\b", r"\bpower.to.(?:gas|x|hydrogen)\b", r"\bipcei\s+hy2(?:tech|use|infra|move)\b", r"\bwasserstoff\b",
            r"\belektrolyse\b", r"\bbrennstoffzelle\b", r"\bhydrog[eè]ne\b", r"\bpile\s+[aà]\s+combustible\b", r"\bhidr[oó]geno\b", r"\bidrogeno\b", r"\bwod[oó]r\b", r"\belektrolizer\b", r"\bwaterstof\b",
        ],
        "moderate": [r"\bdecarboni[sz]\w*\b", r"\bclean\s+energy\b", r"\benergy\s+transition\b", r"\bgreen\s+gas\b"],
    },
    "nuclear": {
        "strong": [
            r"\bnuclear\b", r"\batomic\s+energy\b", r"\bSMR\b", r"\bfission\b", r"\breactor\b", r"\buranium\b", r"\bnucl[eé]aire\b", r"\bnuklear\b", r"\bkernkraft\b", r"\bkernenergie\b", r"\batomkraft\b",
            r"\bnuclear\s+(?:decommission|waste)\b", r"\bspent\s+fuel\b", r"\buran(?:ium)?\b", r"\bydinvoima\b", r"\bydinenergia\b", r"\bjadrov\w*\b", r"\bj[aą]drow\w*\b", r"\belektrowni[aąe]\s+j[aą]drow\w*\b",
        ],
        "moderate": [r"\bbaseload\b", r"\blow\s+carbon\s+electricity\b", r"\benergy\s+security\b", r"\bmining\b", r"\bbergbau\b", r"\bmineral\b"],
    },
    "hydroelectric": {
        "strong": [
            r"\bhydroelectric\b", r"\bhydropower\b", r"\bhydro.?electric\b", r"\bpumped.storage\b", r"\brun.of.river\b", r"\bwasserkraft\b", r"\bpumpspeicher\b", r"\bhydro[eé]lectr\w+\b", r"\bhidroel[eé]ctric\w*\b",
            r"\bidroelettric\w*\b",
        ],
        "moderate": [r"\brenewable\s+energy\b", r"\bclean\s+energy\b"],
    },
    "grid": {
        "strong": [
            r"\btransmission\s+grid\b", r"\belectricity\s+grid\b", r"\binterconnect(?:or|ion)\b", r"\bhigh.voltage\b", r"\b(?:TSO|DSO)\b", r"\bsubmarine\s+cable\b", r"\bsubsea\s+cable\b", r"\btransmission\s+system\s+operator\b",
            r"\bpower\s+line\b", r"\belectricity\s+infrastructure\b", r"\bstromnetz\b", r"\bhochspannung\w*\b", r"\br[eé]seau\s+[eé]lectrique\b", r"\bs[aä]hk[oö]verkko\b", r"\belektriciteitsnet\b",
        ],
        "moderate": [r"\benergy\s+infrastructure\b", r"\belectricity\s+market\b", r"\bstrommarkt\b", r"\bpower\s+system\b"],
    },
    "geothermal": {
        "strong": [r"\bgeothermal\b", r"\bdeep\s+heat\b", r"\bgeothermie\b", r"\berdw[aä]rme\b", r"\bg[eé]otherm\w+\b"],
        "moderate": [r"\brenewable\s+heat\b", r"\bclean\s+heat\b"],
    },
    "steel": {
        "strong": [
            r"\bgreen\s+steel\b", r"\bhydrogen.based\s+steelmaking\b", r"\bdirect\s+reduc(?:ed|tion)\s+iron\b", r"\bDRI\b", r"\belectric\s+arc\s+furnace\b", r"\bEAF\b", r"\bsteel\s+(?:plant|mill|production|decarboni[sz])\w*\b",
            r"\biron\s+and\s+steel\b", r"\bstahl\b", r"\beisen\s+und\s+stahl\b", r"\bhochofen\b", r"\blichtbogenofen\b", r"\bacier\b", r"\bsid[eé]rurg\w+\b", r"\bacero\b", r"\bacciaio\b", r"\bstal(?:owni[aąe])?\b",
            r"\bC\.?24\.?[123]\b", r"\bmanufacture\s+of\s+basic\s+iron\b",
        ],
        "moderate": [
            r"\bets\b", r"\bemission\s+trading\b", r"\bcarbon\s+leakage\b", r"\bindirect\s+emission\b", r"\benergy\s+intensive\b", r"\bstrompreiskompensation\b", r"\bmanufacture\s+of\s+basic\s+metals\b", r"\bmetallurg\w+\b",
            r"\beeg\b", r"\brenewable\s+energy\s+surcharge\b", r"\bstromsteuer\b", r"\belectricity\s+tax\b", r"\benergiesteuer\b", r"\benergy\s+tax\b",
        ],
    },
    "iron": {
        "strong": [r"\bgreen\s+iron\b", r"\bHBI\b", r"\bhot\s+briquetted\s+iron\b", r"\beisenschwamm\b", r"\bheiss\s*brikettiertes\s+eisen\b"],
        "moderate": [r"\biron\s+ore\b", r"\beisenerz\b"],
    },
}
