"""Word lists, labels, seeds and limits that results depend on.

Everything here is data. Each value must stay as it is for results to match; the code
takes all of them as default parameters, so a caller can pass other lists.
"""

# --- collection seeds and limits (fixed values) ---
BANKS = [
    "Attijariwafa Bank",
    "Banque Populaire",
    "BMCE Bank",
    "Société Générale Maroc",
    "Crédit Agricole du Maroc",
    "CIH Bank",
]
CITIES = ["Casablanca", "Rabat", "Fès", "Marrakech", "Tanger", "Agadir", "Meknès", "Oujda"]
MAX_REVIEWS_PER_BRANCH = 100
MAX_BRANCHES_PER_SEARCH = 30
UNKNOWN_BRANCH = "Unknown Branch"
UNKNOWN_LOCATION = "Unknown Location"
UNKNOWN_DATE = "Unknown Date"
NO_TEXT = "No text"

# --- sentiment lexicon: weight of each term (fixed values) ---
LEXICON = {
    "excellent": 0.9,
    "parfait": 0.9,
    "formidable": 0.8,
    "magnifique": 0.8,
    "extraordinaire": 0.8,
    "fantastique": 0.8,
    "merveilleux": 0.8,
    "bon": 0.6,
    "bien": 0.6,
    "super": 0.7,
    "genial": 0.7,
    "top": 0.7,
    "efficace": 0.6,
    "rapide": 0.5,
    "professionnel": 0.6,
    "competent": 0.6,
    "aimable": 0.5,
    "souriant": 0.5,
    "accueillant": 0.5,
    "sympathique": 0.5,
    "satisfait": 0.6,
    "content": 0.6,
    "heureux": 0.7,
    "ravi": 0.7,
    "recommande": 0.6,
    "conseille": 0.5,
    "qualite": 0.5,
    "correct": 0.2,
    "normal": 0.1,
    "standard": 0.1,
    "classique": 0.1,
    "moyen": -0.2,
    "ordinaire": -0.1,
    "banal": -0.2,
    "mauvais": -0.6,
    "mal": -0.6,
    "nul": -0.8,
    "horrible": -0.8,
    "catastrophique": -0.9,
    "deplorable": -0.8,
    "inadmissible": -0.7,
    "lent": -0.5,
    "long": -0.4,
    "attente": -0.4,
    "queue": -0.4,
    "incompetent": -0.7,
    "desagreable": -0.6,
    "impoli": -0.6,
    "mecontentement": -0.6,
    "insatisfait": -0.6,
    "decu": -0.6,
    "probleme": -0.5,
    "difficulte": -0.4,
    "complique": -0.4,
    "refuse": -0.5,
    "rejete": -0.6,
    "bloque": -0.5,
    "scandaleux": -0.9,
    "inacceptable": -0.8,
    "honteux": -0.8,
    "arnaque": -0.9,
    "escroquerie": -0.9,
    "vol": -0.9,
    "fuite": -0.7,
    "eviter": -0.7,
    "deconsille": -0.7,
    "frais": -0.3,
    "commission": -0.2,
    "cout": -0.2,
    "cher": -0.4,
    "gratuit": 0.4,
    "avantageux": 0.5,
    "interessant": 0.4,
    "pret": 0.2,
    "credit": 0.1,
    "compte": 0.1,
    "carte": 0.1,
    "virement": 0.1,
    "depot": 0.1,
    "retrait": 0.1,
    "conseiller": 0.3,
    "directeur": 0.2,
    "guichet": 0.1,
    "agence": 0.1,
    "bureau": 0.1,
    "accueil": 0.2,
    "colere": -0.7,
    "frustration": -0.6,
    "enervement": -0.6,
    "stress": -0.5,
    "anxiete": -0.5,
    "peur": -0.6,
    "confiance": 0.6,
    "securite": 0.5,
    "tranquillite": 0.5,
    "satisfaction": 0.6,
    "plaisir": 0.6,
    "joie": 0.7,
    "pas": 0.0,
    "aucun": 0.0,
    "jamais": 0.0,
    "personne": 0.0,
    "rien": 0.0,
    "ni": 0.0,
    "sans": 0.0,
    "non": 0.0,
}
NEGATORS = ["pas", "non", "aucun", "jamais", "sans"]

# --- ensemble weights and thresholds (fixed values) ---
WEIGHT_POLARITY = 0.25
WEIGHT_VALENCE = 0.35
WEIGHT_LEXICON = 0.40
ENSEMBLE_THRESHOLD = 0.15
LABEL_THRESHOLD = 0.1
LABELS = ["positive", "negative", "neutral"]

# --- published valence rule constants (Hutto & Gilbert, 2014; fixed values) ---
VALENCE_BOOST = 0.293
VALENCE_NEGATION = -0.74
VALENCE_DAMPING = [1.0, 0.95, 0.9]
VALENCE_EXCLAMATION = 0.292
VALENCE_ALPHA = 15.0
VALENCE_CONTRAST = "but"
BOOSTERS = ["très", "tres", "vraiment", "extrêmement", "extremement", "totalement", "trop", "tellement"]
DAMPENERS = ["peu", "presque", "légèrement", "legerement", "plutôt", "plutot"]

# --- text preparation (fixed values) ---
MIN_REVIEW_CHARS = 10
MIN_REVIEW_WORDS = 3
FRENCH_STOP_WORDS = [
    "au", "aux", "avec", "ce", "ces", "dans", "de", "des", "du", "elle", "en", "et", "eux", "il", "je", "la", "le",
    "les", "leur", "lui", "ma", "mais", "me", "même", "mes", "moi", "mon", "ne", "nos", "notre", "nous", "on", "ou",
    "par", "pas", "pour", "qu", "que", "qui", "sa", "se", "ses", "son", "sur", "ta", "te", "tes", "toi", "ton", "tu",
    "un", "une", "vos", "votre", "vous", "c", "d", "j", "l", "à", "m", "n", "s", "t", "y", "été", "étée", "étées",
    "étés", "étant", "étante", "étants", "étantes", "suis", "es", "est", "sommes", "êtes", "sont", "serai", "seras",
    "sera", "serons", "serez", "seront", "serais", "serait", "serions", "seriez", "seraient", "étais", "était",
    "étions", "étiez", "étaient", "fus", "fut", "fûmes", "fûtes", "furent", "sois", "soit", "soyons", "soyez",
    "soient", "fusse", "fusses", "fût", "fussions", "fussiez", "fussent", "ayant", "ayante", "ayantes", "ayants",
    "eu", "eue", "eues", "eus", "ai", "as", "avons", "avez", "ont", "aurai", "auras", "aura", "aurons", "aurez",
    "auront", "aurais", "aurait", "aurions", "auriez", "auraient", "avais", "avait", "avions", "aviez", "avaient",
    "eut", "eûmes", "eûtes", "eurent", "aie", "aies", "ait", "ayons", "ayez", "aient", "eusse", "eusses", "eût",
    "eussions", "eussiez", "eussent",
]
DOMAIN_STOP_WORDS = [
    "banque", "agence", "client", "service", "monsieur", "madame", "bonjour", "merci", "salut", "bjr", "slt", "dh",
    "dirham", "très", "bien", "mal", "bon", "mauvais",
]
STOP_WORDS = FRENCH_STOP_WORDS + DOMAIN_STOP_WORDS
ACCENTED = "àáâäãèéêëìíîïòóôöõùúûüçñ"
UNACCENTED = "aaaaaeeeeiiiiooooouuuucn"

# --- topics (fixed values) ---
TOPIC_STOP_WORDS = [
    "banque", "bank", "agence", "branch", "client", "customer", "service", "avis", "review", "experience", "fois",
    "jour", "toujours", "souvent", "parfois", "jamais", "aller", "venir",
]
THEMES = {
    "service_client": [
        "accueil", "personnel", "conseiller", "equipe", "staff", "employe", "service", "aide", "assistance",
        "conseil", "information", "explication", "competent", "professionnel", "aimable", "souriant", "sympathique",
        "impoli", "desagreable", "incompetent",
    ],
    "attente_temps": [
        "attente", "queue", "file", "long", "lent", "rapide", "vite", "temps", "minute", "heure", "patience", "delai",
        "duree", "urgent", "immediat", "retard",
    ],
    "frais_tarifs": [
        "frais", "tarif", "prix", "cout", "cher", "expensive", "gratuit", "commission", "fee", "facturation",
        "montant", "argent", "economique", "avantageux", "raisonnable", "abusif",
    ],
    "services_bancaires": [
        "compte", "carte", "credit", "pret", "virement", "depot", "retrait", "banque", "banking", "financier",
        "transaction", "operation", "ouverture", "fermeture", "activation", "blocage",
    ],
    "technologie_digital": [
        "application", "app", "site", "internet", "online", "digital", "mobile", "telephone", "ordinateur",
        "electronique", "automatique", "distributeur", "atm", "terminal", "technologie", "systeme",
    ],
    "localisation_agence": [
        "agence", "bureau", "succursale", "local", "batiment", "lieu", "adresse", "quartier", "ville", "proche",
        "loin", "accessible", "parking", "transport", "metro", "bus", "voiture",
    ],
    "problemes_reclamations": [
        "probleme", "erreur", "bug", "panne", "dysfonctionnement", "reclamation", "plainte", "litige", "conflit",
        "resolution", "solution", "reparation", "correction", "amelioration",
    ],
    "satisfaction_generale": [
        "satisfait", "content", "heureux", "ravi", "plaisir", "recommande", "excellent", "parfait", "super", "top",
        "genial", "formidable", "decevant", "decu", "insatisfait", "mauvais", "horrible", "nul",
    ],
}
VOCABULARY_SIZE = 1000
MIN_DOC_COUNT = 2
MAX_DOC_SHARE = 0.8
TOPIC_SEED = 42
TOPIC_COUNT = 8
MAX_TOPIC_COUNT = 15
TOPIC_THRESHOLD = 0.3
UNCERTAIN_TOPIC = -1
MIN_TOPIC_DOCUMENTS = 10

# --- warehouse seeds (fixed values) ---
SENTIMENT_ROWS = [
    ("positive", "Avis exprimant une satisfaction", 0.1, 1.0),
    ("negative", "Avis exprimant une insatisfaction", -1.0, -0.1),
    ("neutral", "Avis neutres ou mitigés", -0.1, 0.1),
    ("unknown", "Sentiment non déterminé", None, None),
]
TOPIC_ROWS = [
    ("service_client", "Qualité de l'accueil et du service client"),
    ("attente_temps", "Temps d'attente et rapidité du service"),
    ("frais_tarifs", "Frais bancaires et tarification"),
    ("services_bancaires", "Services et produits bancaires"),
    ("technologie_digital", "Services numériques et technologie"),
    ("localisation_agence", "Emplacement et accessibilité des agences"),
    ("problemes_reclamations", "Problèmes techniques et réclamations"),
    ("satisfaction_generale", "Satisfaction générale et recommandations"),
    ("autres", "Autres sujets non classifiés"),
]
DEFAULT_SENTIMENT = "unknown"
DEFAULT_TOPIC = "autres"
MONTH_NAMES = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre"]
DAY_NAMES = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2024-12-31"

# --- display buckets (fixed values) ---
RATING_NAMES = ["Excellent (5★)", "Bon (4★)", "Moyen (3★)", "Mauvais (1-2★)"]
RATING_UNRATED = "Non noté"
RATING_UNEVALUATED = "Non évalué"
RATING_SHORT_NAMES = ["Excellent", "Bon", "Moyen", "Faible"]
SENTIMENT_NAMES = {"positive": "😊 Positif", "negative": "😞 Négatif", "neutral": "😐 Neutre"}
SENTIMENT_OTHER = "❓ Inconnu"
SENTIMENT_SHORT_NAMES = {"positive": "Positif 😊", "negative": "Negatif 😞"}
SENTIMENT_SHORT_OTHER = "Neutre 😐"
QUALITY_NAMES = ["Haute", "Moyenne", "Basse", "Très basse"]
LENGTH_NAMES = [
    "Très détaillé (>50 mots)",
    "Détaillé (20-50 mots)",
    "Moyen (10-19 mots)",
    "Court (<10 mots)",
]
