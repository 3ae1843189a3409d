"""ISO 3166-1 codes of the map feed (fixed values): alpha-2, numeric, name."""

COUNTRY_CODES = (
    ("AE", "784", "United Arab Emirates"),
    ("AR", "032", "Argentina"),
    ("AU", "036", "Australia"),
    ("AT", "040", "Austria"),
    ("BD", "050", "Bangladesh"),
    ("BE", "056", "Belgium"),
    ("BR", "076", "Brazil"),
    ("CA", "124", "Canada"),
    ("CH", "756", "Switzerland"),
    ("CL", "152", "Chile"),
    ("CN", "156", "China"),
    ("CO", "170", "Colombia"),
    ("CZ", "203", "Czechia"),
    ("DE", "276", "Germany"),
    ("DK", "208", "Denmark"),
    ("EG", "818", "Egypt"),
    ("ES", "724", "Spain"),
    ("FI", "246", "Finland"),
    ("FR", "250", "France"),
    ("GB", "826", "United Kingdom"),
    ("GR", "300", "Greece"),
    ("HK", "344", "Hong Kong"),
    ("HU", "348", "Hungary"),
    ("ID", "360", "Indonesia"),
    ("IE", "372", "Ireland"),
    ("IL", "376", "Israel"),
    ("IN", "356", "India"),
    ("IR", "364", "Iran"),
    ("IT", "380", "Italy"),
    ("JP", "392", "Japan"),
    ("KR", "410", "South Korea"),
    ("KZ", "398", "Kazakhstan"),
    ("MX", "484", "Mexico"),
    ("MY", "458", "Malaysia"),
    ("NG", "566", "Nigeria"),
    ("NL", "528", "Netherlands"),
    ("NO", "578", "Norway"),
    ("NZ", "554", "New Zealand"),
    ("PE", "604", "Peru"),
    ("PH", "608", "Philippines"),
    ("PK", "586", "Pakistan"),
    ("PL", "616", "Poland"),
    ("PT", "620", "Portugal"),
    ("RO", "642", "Romania"),
    ("RU", "643", "Russia"),
    ("SA", "682", "Saudi Arabia"),
    ("SE", "752", "Sweden"),
    ("SG", "702", "Singapore"),
    ("TH", "764", "Thailand"),
    ("TR", "792", "Turkey"),
    ("TW", "158", "Taiwan"),
    ("UA", "804", "Ukraine"),
    ("US", "840", "United States"),
    ("VE", "862", "Venezuela"),
    ("VN", "704", "Vietnam"),
    ("ZA", "710", "South Africa"),
)
