"""Words and bounds of the synthetic order data."""

from __future__ import annotations

from dataclasses import dataclass

# Every list below must hold exactly these entries in this order for
# generated rows to carry the expected labels.

# (city, department, region)
CITIES = (
    ("Loudéac", "22", "Bretagne"),
    ("Saint-Brieuc", "22", "Bretagne"),
    ("Lannion", "22", "Bretagne"),
    ("Dinan", "22", "Bretagne"),
    ("Guingamp", "22", "Bretagne"),
    ("Pontivy", "56", "Bretagne"),
    ("Vannes", "56", "Bretagne"),
    ("Lorient", "56", "Bretagne"),
    ("Ploërmel", "56", "Bretagne"),
    ("Quimper", "29", "Bretagne"),
    ("Brest", "29", "Bretagne"),
    ("Morlaix", "29", "Bretagne"),
    ("Carhaix-Plouguer", "29", "Bretagne"),
    ("Rennes", "35", "Bretagne"),
    ("Fougères", "35", "Bretagne"),
    ("Vitré", "35", "Bretagne"),
    ("Redon", "35", "Bretagne"),
    ("Nantes", "44", "Pays de la Loire"),
    ("Châteaubriant", "44", "Pays de la Loire"),
    ("Ancenis", "44", "Pays de la Loire"),
    ("Angers", "49", "Pays de la Loire"),
    ("Cholet", "49", "Pays de la Loire"),
    ("Saumur", "49", "Pays de la Loire"),
    ("Laval", "53", "Pays de la Loire"),
    ("Mayenne", "53", "Pays de la Loire"),
    ("Château-Gontier", "53", "Pays de la Loire"),
    ("Le Mans", "72", "Pays de la Loire"),
    ("La Flèche", "72", "Pays de la Loire"),
    ("La Roche-sur-Yon", "85", "Pays de la Loire"),
    ("Les Herbiers", "85", "Pays de la Loire"),
    ("Fontenay-le-Comte", "85", "Pays de la Loire"),
    ("Niort", "79", "Nouvelle-Aquitaine"),
    ("Parthenay", "79", "Nouvelle-Aquitaine"),
    ("Bressuire", "79", "Nouvelle-Aquitaine"),
    ("Poitiers", "86", "Nouvelle-Aquitaine"),
    ("Caen", "14", "Normandie"),
    ("Bayeux", "14", "Normandie"),
    ("Lisieux", "14", "Normandie"),
    ("Saint-Lô", "50", "Normandie"),
    ("Avranches", "50", "Normandie"),
    ("Coutances", "50", "Normandie"),
    ("Alençon", "61", "Normandie"),
    ("Flers", "61", "Normandie"),
    ("Argentan", "61", "Normandie"),
    ("Évreux", "27", "Normandie"),
    ("Rouen", "76", "Normandie"),
    ("Amiens", "80", "Hauts-de-France"),
    ("Arras", "62", "Hauts-de-France"),
    ("Lille", "59", "Hauts-de-France"),
    ("Saint-Quentin", "02", "Hauts-de-France"),
    ("Rodez", "12", "Occitanie"),
    ("Aurillac", "15", "Auvergne-Rhône-Alpes"),
    ("Clermont-Ferrand", "63", "Auvergne-Rhône-Alpes"),
    ("Limoges", "87", "Nouvelle-Aquitaine"),
    ("Tulle", "19", "Nouvelle-Aquitaine"),
    ("Bourges", "18", "Centre-Val de Loire"),
    ("Châteauroux", "36", "Centre-Val de Loire"),
    ("Tours", "37", "Centre-Val de Loire"),
    ("Blois", "41", "Centre-Val de Loire"),
    ("Orléans", "45", "Centre-Val de Loire"),
    ("Chartres", "28", "Centre-Val de Loire"),
    ("Troyes", "10", "Grand Est"),
    ("Dijon", "21", "Bourgogne-Franche-Comté"),
    ("Mâcon", "71", "Bourgogne-Franche-Comté"),
    ("Lons-le-Saunier", "39", "Bourgogne-Franche-Comté"),
    ("Besançon", "25", "Bourgogne-Franche-Comté"),
    ("Épinal", "88", "Grand Est"),
    ("Nancy", "54", "Grand Est"),
    ("Metz", "57", "Grand Est"),
    ("Strasbourg", "67", "Grand Est"),
    ("Colmar", "68", "Grand Est"),
    ("Bourg-en-Bresse", "01", "Auvergne-Rhône-Alpes"),
    ("Lyon", "69", "Auvergne-Rhône-Alpes"),
    ("Grenoble", "38", "Auvergne-Rhône-Alpes"),
    ("Chambéry", "73", "Auvergne-Rhône-Alpes"),
    ("Annecy", "74", "Auvergne-Rhône-Alpes"),
    ("Valence", "26", "Auvergne-Rhône-Alpes"),
    ("Toulouse", "31", "Occitanie"),
    ("Auch", "32", "Occitanie"),
    ("Tarbes", "65", "Occitanie"),
    ("Pau", "64", "Nouvelle-Aquitaine"),
    ("Mont-de-Marsan", "40", "Nouvelle-Aquitaine"),
    ("Agen", "47", "Nouvelle-Aquitaine"),
    ("Périgueux", "24", "Nouvelle-Aquitaine"),
    ("Bordeaux", "33", "Nouvelle-Aquitaine"),
    ("Angoulême", "16", "Nouvelle-Aquitaine"),
    ("La Rochelle", "17", "Nouvelle-Aquitaine"),
    ("Cahors", "46", "Occitanie"),
    ("Montauban", "82", "Occitanie"),
    ("Albi", "81", "Occitanie"),
    ("Carcassonne", "11", "Occitanie"),
    ("Perpignan", "66", "Occitanie"),
    ("Montpellier", "34", "Occitanie"),
    ("Nîmes", "30", "Occitanie"),
    ("Avignon", "84", "Provence-Alpes-Côte d Azur"),
    ("Marseille", "13", "Provence-Alpes-Côte d Azur"),
    ("Gap", "05", "Provence-Alpes-Côte d Azur"),
    ("Digne-les-Bains", "04", "Provence-Alpes-Côte d Azur"),
    ("Nice", "06", "Provence-Alpes-Côte d Azur"),
    ("Melun", "77", "Île-de-France"),
)

SURNAMES = (
    "Le Goff", "Le Roux", "Tanguy", "Le Gall", "Guillou", "Morvan", "Riou", "Le Bras", "Hamon",
    "Jaouen", "Martin", "Bernard", "Dubois", "Thomas", "Robert", "Richard", "Petit", "Durand",
    "Leroy", "Moreau", "Simon", "Laurent", "Lefebvre", "Michel", "Garcia", "David", "Bertrand",
    "Roux", "Vincent", "Fournier", "Morel", "Girard", "André", "Mercier", "Dupont", "Lambert",
    "Bonnet", "François", "Martinez", "Legrand", "Garnier", "Faure", "Rousseau", "Blanc", "Guérin",
    "Muller", "Henry", "Roussel", "Nicolas", "Perrin",
)

FIRST_NAMES = (
    "Yann", "Morgane", "Erwan", "Anne", "Gwenaël", "Solenn", "Loïc", "Nolwenn", "Thomas", "Julie",
    "Pierre", "Marie", "Nicolas", "Sophie", "Julien", "Camille", "Maxime", "Léa", "Antoine",
    "Chloé", "Alexandre", "Manon", "Vincent", "Élodie",
)

PLACES = (
    "Kerguelen", "Kerbiquet", "La Ville Neuve", "Les Landes", "Le Bourg", "La Croix", "Kervran",
    "Le Clos", "Les Rouges Terres", "La Grande Métairie", "Kerlouan", "Le Moulin", "Beaulieu",
    "La Haute Folie", "Kerandraon", "Le Pont Neuf", "Les Fontaines", "Kerdaniel", "Le Verger",
    "La Chesnaie",
)

BRANDS = (
    "Vital Concept", "Bio Armor", "AgriNova", "Lacme", "Gallagher", "Stihl", "Husqvarna",
    "Kärcher", "La Buvette", "Suevia", "Patura", "Zoetis", "Elanco", "MSD", "Novatech",
    "Lallemand", "KWS", "Pioneer", "Yara", "Timac Agro", "Aigle", "Le Chameau", "Delta Plus",
    "Portwest",
)

# Lowest and highest list price of each product category, in whole currency units.
PRICE_BOUNDS = (
    (8, 60), (15, 180), (30, 1500), (5, 400), (20, 350), (40, 2500), (5, 120), (8, 900),
)

DISCOUNT_PERCENTS = (0, 0, 0, 5, 10)
REPS_PER_REGION = 12
MOST_LINES_PER_ORDER = 7
QUANTITY_SPAN = 30
FIRST_DAY = "2023-01-01"
DAYS = 1096


@dataclass(frozen=True)
class Words:
    """Labels that depend on the language."""

    legal_forms: tuple[str, ...]
    segments: tuple[str, ...]
    prefixes: tuple[str, ...]
    categories: tuple[tuple[str, tuple[str, ...]], ...]  # (category, product names)


ENGLISH = Words(
    ("EARL", "GAEC", "SCEA", "SARL", "Farm", "Estate", "EARL", "GAEC", "SCEA", "Farm"),
    (
        "Dairy cattle farmer", "Beef cattle farmer", "Pig farmer", "Poultry farmer",
        "Arable farmer", "Market gardener", "Winegrower", "Sheep and goat farmer",
        "Private customer",
    ),
    ("", "", "Premium ", "Eco ", "Pro "),
    (
        ("Animal feed", (
            "Dairy cow feed 25 kg", "Calf feed 25 kg", "Pig grower pellets 25 kg",
            "Layer hen feed 20 kg", "Poultry mash 25 kg", "Alfalfa hay 300 kg",
            "Mineral lick block 10 kg", "Sheep concentrate 25 kg",
        )),
        ("Animal hygiene and health", (
            "Barn disinfectant 20 L", "Cattle dewormer 1 L", "Teat dip 20 L",
            "Mineral supplement 25 kg", "Hoof spray 500 mL", "Teat wipes x1000",
            "Barn insecticide 5 L",
        )),
        ("Livestock and buildings", (
            "Constant-level water trough", "Galvanized hay rack", "6-place feed barrier",
            "Rubber cubicle mat", "Galvanized gate 4 m", "Piglet feeder",
            "Infrared heat lamp 250 W", "Barn fan 50 cm",
        )),
        ("Fencing", (
            "Fence energizer 12 V", "Fiberglass posts x50", "Fence wire 400 m",
            "Ring insulators x100", "Electric gate handle", "Fence tape 200 m",
            "Battery 12 V 100 Ah",
        )),
        ("Seeds and crops", (
            "Maize seed 50,000 kernels", "Perennial ryegrass 25 kg", "Red clover 10 kg",
            "Wheat seed 25 kg", "NPK fertilizer 15-15-15 50 kg", "Silage sheet 12 x 50 m",
            "Round bale net 3000 m", "Bale wrap film 750 mm",
        )),
        ("Equipment and tools", (
            "Backpack sprayer 16 L", "Petrol chainsaw 45 cm", "Brushcutter 42 cc",
            "Pressure washer 150 bar", "Petrol water pump", "Generator 5 kVA",
            "Wheelbarrow 100 L", "Compressor 50 L",
        )),
        ("Workwear and PPE", (
            "Farm boots", "Work overalls", "Milking gloves x100", "Rain jacket",
            "Multi-pocket trousers", "Safety shoes S3", "Bib overalls",
        )),
        ("Garden and green spaces", (
            "Petrol lawnmower 51 cm", "Potting soil 70 L", "Garden hose 50 m",
            "Hard-wearing lawn seed 5 kg", "Pro pruning shears", "Tunnel greenhouse 6 m2",
            "Electric hedge trimmer",
        )),
    ),
)

FRENCH = Words(
    (
        "EARL", "GAEC", "SCEA", "SARL", "Ferme", "Domaine", "EARL de", "GAEC de", "SCEA du",
        "Ferme de",
    ),
    (
        "Éleveur bovin lait", "Éleveur bovin viande", "Éleveur porcin", "Aviculteur",
        "Grandes cultures", "Maraîcher", "Viticulteur", "Éleveur ovin-caprin", "Particulier",
    ),
    ("", "", "Premium ", "Éco ", "Pro "),
    (
        ("Alimentation animale", (
            "Aliment vaches laitières 25 kg", "Aliment veaux 25 kg",
            "Granulés porcs croissance 25 kg", "Aliment poules pondeuses 20 kg",
            "Mash volailles 25 kg", "Foin de luzerne 300 kg", "Bloc à lécher 10 kg",
            "Concentré ovins 25 kg",
        )),
        ("Hygiène et santé animale", (
            "Désinfectant bâtiment 20 L", "Vermifuge bovins 1 L",
            "Produit de trempage trayons 20 L", "Complément minéral 25 kg",
            "Spray onglons 500 mL", "Lingettes de trayon x1000", "Insecticide bâtiment 5 L",
        )),
        ("Élevage et bâtiment", (
            "Abreuvoir à niveau constant", "Râtelier galvanisé", "Cornadis 6 places",
            "Tapis logette caoutchouc", "Barrière galvanisée 4 m", "Nourrisseur porcelets",
            "Lampe chauffante IR 250 W", "Ventilateur bâtiment 50 cm",
        )),
        ("Clôture", (
            "Électrificateur 12 V", "Piquet fibre de verre x50", "Fil de clôture 400 m",
            "Isolateur annulaire x100", "Poignée de porte électrique", "Ruban de clôture 200 m",
            "Batterie 12 V 100 Ah",
        )),
        ("Semences et cultures", (
            "Semence maïs 50 000 grains", "Ray-grass anglais 25 kg", "Trèfle violet 10 kg",
            "Blé tendre semence 25 kg", "Engrais NPK 15-15-15 50 kg",
            "Bâche ensilage 12 x 50 m", "Filet balles rondes 3000 m",
            "Film enrubannage 750 mm",
        )),
        ("Équipement et outillage", (
            "Pulvérisateur à dos 16 L", "Tronçonneuse thermique 45 cm",
            "Débroussailleuse 42 cc", "Nettoyeur haute pression 150 bar",
            "Pompe à eau thermique", "Groupe électrogène 5 kVA", "Brouette 100 L",
            "Compresseur 50 L",
        )),
        ("Vêtements et EPI", (
            "Bottes agricoles", "Combinaison de travail", "Gants de traite x100",
            "Veste de pluie", "Pantalon multipoches", "Chaussures de sécurité S3",
            "Cotte à bretelles",
        )),
        ("Jardin et espaces verts", (
            "Tondeuse thermique 51 cm", "Terreau universel 70 L", "Tuyau arrosage 50 m",
            "Gazon rustique 5 kg", "Sécateur pro", "Serre tunnel 6 m2",
            "Taille-haie électrique",
        )),
    ),
)

WORDS = {"en": ENGLISH, "fr": FRENCH}
