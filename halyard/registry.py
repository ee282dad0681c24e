"""Registries the operators take as arguments: metrics, sources of units, alert fields, dictionaries."""

from __future__ import annotations

# Metric -> (wide column, unit). Directions are averaged on the circle.
METRICS = {
    "wind_speed": ("wind_speed_ms", "m/s"),
    "wind_gusts": ("wind_gusts_ms", "m/s"),
    "wind_direction": ("wind_direction_deg", "deg"),
    "air_temperature": ("air_temperature_c", "degC"),
    "relative_humidity": ("relative_humidity_pct", "%"),
    "dew_point": ("dew_point_c", "degC"),
    "pressure_msl": ("pressure_msl_hpa", "hPa"),
    "surface_pressure": ("surface_pressure_hpa", "hPa"),
    "cloud_cover": ("cloud_cover_pct", "%"),
    "cloud_cover_low": ("cloud_cover_low_pct", "%"),
    "cloud_cover_mid": ("cloud_cover_mid_pct", "%"),
    "cloud_cover_high": ("cloud_cover_high_pct", "%"),
    "precipitation": ("precipitation_mm", "mm"),
    "weather_visibility": ("weather_visibility_m", "m"),
    "wave_height": ("wave_height_m", "m"),
    "wave_period": ("wave_period_s", "s"),
    "wave_direction": ("wave_direction_deg", "deg"),
    "wind_wave_height": ("wind_wave_height_m", "m"),
    "wind_wave_period": ("wind_wave_period_s", "s"),
    "wind_wave_direction": ("wind_wave_direction_deg", "deg"),
    "swell_wave_height": ("swell_wave_height_m", "m"),
    "swell_wave_period": ("swell_wave_period_s", "s"),
    "swell_wave_direction": ("swell_wave_direction_deg", "deg"),
    "secondary_swell_wave_height": ("secondary_swell_wave_height_m", "m"),
    "secondary_swell_wave_period": ("secondary_swell_wave_period_s", "s"),
    "secondary_swell_wave_direction": ("secondary_swell_wave_direction_deg", "deg"),
    "water_temperature": ("water_temperature_c", "degC"),
    "sea_level_height": ("sea_level_height_m", "m"),
    "tide_coefficient": ("tide_coefficient", "coef"),
    "current_speed": ("current_speed_ms", "m/s"),
    "current_direction": ("current_direction_deg", "deg"),
    "salinity": ("salinity_psu", "psu"),
    "chlorophyll": ("chlorophyll_mg_m3", "mg/m3"),
    "phytoplankton_carbon": ("phytoplankton_carbon_mmol_m3", "mmol/m3"),
    "net_primary_production": ("net_primary_production_mg_m3_day", "mg/m3/day"),
    "euphotic_depth": ("euphotic_depth_m", "m"),
    "algal_bloom_risk": ("algal_bloom_risk", "score"),
    "light_attenuation": ("light_attenuation_m1", "1/m"),
}
CIRCULAR = tuple(m for m, (_, unit) in METRICS.items() if unit == "deg")
COLUMN = {m: c for m, (c, _) in METRICS.items()}
#: Metrics whose unit label is kept as delivered.
OWN_UNIT = ("chlorophyll", "light_attenuation")

# Factor to m/s of a velocity unit, spaces removed and lower-cased.
TO_MS = {
    "km/h": 1 / 3.6, "kmh": 1 / 3.6, "kilometer/hour": 1 / 3.6, "kilometre/hour": 1 / 3.6,
    "kn": 0.514444, "kt": 0.514444, "kts": 0.514444, "knots": 0.514444,
    "mph": 0.44704,
}
VELOCITIES = ("wind_speed", "wind_gusts", "current_speed")

# Alert condition types that name a forecast column directly.
CONDITION_COLUMNS = {
    "air_temperature": "air_temperature_c",
    "chlorophyll": "chlorophyll_mg_m3",
    "cloud_cover": "cloud_cover_pct",
    "cloud_cover_low": "cloud_cover_low_pct",
    "current_direction": "current_direction_deg",
    "current_speed": "current_speed_ms",
    "dew_point": "dew_point_c",
    "precipitation": "precipitation_mm",
    "pressure_msl": "pressure_msl_hpa",
    "relative_humidity": "relative_humidity_pct",
    "salinity": "salinity_psu",
    "water_temperature": "water_temperature_c",
    "wave_direction": "wave_direction_deg",
    "wave_height": "wave_height_m",
    "wave_period": "wave_period_s",
    "weather_visibility": "weather_visibility_m",
    "wind_direction": "wind_direction_deg",
    "wind_gusts": "wind_gusts_ms",
    "wind_speed": "wind_speed_ms",
    "secondary_swell_height": "secondary_swell_wave_height_m",
    "secondary_swell_period": "secondary_swell_wave_period_s",
    "swell_height": "swell_wave_height_m",
    "swell_period": "swell_wave_period_s",
}
DERIVED_CONDITIONS, UNFORECASTABLE_CONDITIONS = ("condition_score",), ("visibility",)
# Labels, without accents and lower-cased, of other condition types.
LABEL_COLUMNS = {
    "temperature de l'eau": "water_temperature_c",
    "temperature de l'air": "air_temperature_c",
    "humidite": "relative_humidity_pct",
    "point de rosee": "dew_point_c",
    "hauteur des vagues": "wave_height_m",
    "periode des vagues": "wave_period_s",
    "houle": "swell_wave_height_m",
    "periode de houle": "swell_wave_period_s",
    "vitesse du vent": "wind_speed_ms",
    "rafales de vent": "wind_gusts_ms",
    "precipitations": "precipitation_mm",
    "couverture nuageuse": "cloud_cover_pct",
    "nuages bas": "cloud_cover_low_pct",
    "nuages moyens": "cloud_cover_mid_pct",
    "nuages hauts": "cloud_cover_high_pct",
    "pression": "pressure_msl_hpa",
    "pressure": "pressure_msl_hpa",
    "visibilite meteo": "weather_visibility_m",
    "maree": "sea_level_height_m",
    "sea_level": "sea_level_height_m",
    "coefficient de maree": "tide_coefficient",
    "coef de maree": "tide_coefficient",
    "courant": "current_speed_ms",
    "salinite": "salinity_psu",
    "chlorophylle": "chlorophyll_mg_m3",
    "carbone phytoplancton": "phytoplankton_carbon_mmol_m3",
    "production primaire": "net_primary_production_mg_m3_day",
    "profondeur euphotique": "euphotic_depth_m",
    "risque bloom algal": "algal_bloom_risk",
    "bloom algal": "algal_bloom_risk",
    "efflorescence planctonique": "algal_bloom_risk",
    "water_temperature": "water_temperature_c",
    "air_temperature": "air_temperature_c",
    "relative_humidity": "relative_humidity_pct",
    "dew_point": "dew_point_c",
    "wave_height": "wave_height_m",
    "wave_period": "wave_period_s",
    "swell_wave_height": "swell_wave_height_m",
    "swell_wave_period": "swell_wave_period_s",
    "wind_speed": "wind_speed_ms",
    "wind_gusts": "wind_gusts_ms",
    "precipitation": "precipitation_mm",
    "cloud_cover": "cloud_cover_pct",
    "cloud_cover_low": "cloud_cover_low_pct",
    "cloud_cover_mid": "cloud_cover_mid_pct",
    "cloud_cover_high": "cloud_cover_high_pct",
    "weather_visibility": "weather_visibility_m",
    "tide_coefficient": "tide_coefficient",
    "current_speed": "current_speed_ms",
    "salinity": "salinity_psu",
    "chlorophyll": "chlorophyll_mg_m3",
    "phytoplankton_carbon": "phytoplankton_carbon_mmol_m3",
    "net_primary_production": "net_primary_production_mg_m3_day",
    "euphotic_depth": "euphotic_depth_m",
    "algal_bloom_risk": "algal_bloom_risk",
}
# Penalties of the marine score: column -> (value of the full penalty, full penalty).
SCORE_PENALTIES = {
    "wave_height_m": (2.5, 35.0),
    "wind_speed_ms": (15.0, 25.0),
    "wind_gusts_ms": (22.0, 15.0),
    "current_speed_ms": (1.2, 15.0),
    "precipitation_mm": (8.0, 10.0),
}

# Words that mark a link or source as relevant or not.
RELEVANT_WORDS = (
    "peche", "loisir", "reglement", "reglementation", "arrete", "capture", "taille", "tailles", "quota", "quotas", "bar", "lieu",
    "maquereau", "thon", "espadon", "merou", "corb", "coquillage", "crustace", "oursin", "sous-marine", "plongee", "calanques",
    "golfe", "autorisation", "declaration", "enregistrement", "marquage", "engin", "filet", "casier", "arretes",
)
NEGATIVE_WORDS = ("accessibilite", "contact", "newsletter", "mentions-legales", "plan-du-site", "recrutement", "marche-public", "communique", "presse")

# Species names and their spellings in folded text, in order of search.
SPECIES = {
    "bar": ("bar europeen", "bar"),
    "lieu jaune": ("lieu jaune",),
    "maquereau": ("maquereau",),
    "araignees": ("araignees de mer", "araignee de mer", "araignees", "araignee"),
    "pouces-pieds": ("pouces-pieds", "pouces pieds"),
    "coquilles saint-jacques": ("coquilles saint-jacques", "coquille saint-jacques"),
    "ormeaux": ("ormeaux", "ormeau"),
    "homard": ("homards", "homard"),
    "tourteau": ("tourteaux", "tourteau"),
    "thon rouge": ("thon rouge",),
    "dorade rose": ("dorade rose",),
    "dorade coryphene": ("dorade coryphene",),
    "merou": ("merou", "merous"),
    "corb": ("corb",),
    "raie brunette": ("raie brunette",),
    "espadon": ("espadon",),
    "denti": ("denti",),
}
# Scientific names of species.
SCIENTIFIC = {
    "bar": "Dicentrarchus labrax", "lieu jaune": "Pollachius pollachius", "maquereau": "Scomber scombrus", "araignees": "Maja squinado",
    "homard": "Homarus gammarus", "tourteau": "Cancer pagurus", "thon rouge": "Thunnus thynnus", "dorade rose": "Pagellus bogaraveo",
    "dorade coryphene": "Coryphaena hippurus", "merou": "Epinephelus marginatus", "corb": "Sciaena umbra", "espadon": "Xiphias gladius",
    "denti": "Dentex dentex",
}
# Words of crustaceans in a folded species name.
CRUSTACEANS = ("homard", "araignee", "tourteau", "langouste", "langoustine", "crabe", "etrille")
# Place of each type of rule in the order of rules; its activity; its constraint.
RULE_RANK = {
    "DIVING_GENERAL": 10, "SPEARFISHING_GENERAL": 20, "PRACTICE_RULE": 25, "MIN_SIZE": 30, "QUOTA": 40, "CLOSURE_PERIOD": 50,
    "PROTECTED_SPECIES": 60, "LOCAL_RESTRICTION": 70,
}
RULE_ACTIVITY = {"DIVING_GENERAL": "diving", "SPEARFISHING_GENERAL": "spearfishing"}
OTHER_ACTIVITY = "recreational_fishing"
RULE_CONSTRAINT = {
    "DIVING_GENERAL": "safety_framework", "SPEARFISHING_GENERAL": "practice_rule", "MIN_SIZE": "min_size", "QUOTA": "quota",
    "CLOSURE_PERIOD": "closure_period", "PROTECTED_SPECIES": "forbidden_capture", "PRACTICE_RULE": "practice_rule",
    "LOCAL_RESTRICTION": "declaration_or_local_rule",
}
# Months in folded text.
MONTHS = ("janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre")

# The zone of a scope: code, name, least and largest latitude and longitude; and of any other scope.
ZONES = {
    "namo": ("FACADE_NAMO", "Facade Nord Atlantique Manche Ouest", 46.0, 51.4, -6.8, 0.2),
    "memn": ("FACADE_MEMN", "Facade Manche Est Mer du Nord", 48.2, 51.5, -2.0, 4.2),
    "sud-atlantique": ("FACADE_SUD_ATLANTIQUE", "Facade Sud Atlantique", 42.9, 47.4, -2.5, -0.8),
    "mediterranee": ("FACADE_MEDITERRANEE", "Facade Mediterranee", 41.0, 44.9, 2.2, 9.9),
    "bretagne": ("REGION_BRETAGNE", "Bretagne", 47.0, 49.2, -5.8, -1.0),
    "pays-de-la-loire": ("REGION_PAYS_DE_LA_LOIRE", "Pays de la Loire", 46.0, 47.9, -3.0, -0.7),
    "golfe-du-lion": ("SECTEUR_GOLFE_DU_LION", "Golfe du Lion", 42.2, 43.7, 2.5, 5.1),
    "calanques": ("SECTEUR_CALANQUES", "Parc national des Calanques", 43.0, 43.35, 5.25, 5.6),
    "corse": ("SECTEUR_CORSE", "Corse", 41.2, 43.2, 8.4, 9.7),
    "north-48n": ("SECTEUR_NORD_48N", "Nord du parallele 48N", 48.0, 51.5, -6.8, 4.2),
    "south-48n": ("SECTEUR_SUD_48N", "Sud du parallele 48N", 41.0, 48.0, -6.8, 9.9),
}
ALL_ZONES = ("APP_ZONES_UNION", "Union geospatiale des zones de l'application")
