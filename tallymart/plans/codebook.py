"""Code lists of the national quality-of-life survey.

Fixed values: codes and labels are those of the official survey dictionary.
"""

DWELLING_TYPE = {
    "1": "Casa",
    "2": "Apartamento",
    "3": "Cuarto(s)",
    "4": "Vivienda (casa) indígena",
    "5": "Otro tipo de vivienda (carpa, vagón, embarcación, cueva, etc.)",
}

WALL_MATERIAL = {
    "1": "Bloque, ladrillo, piedra, madera pulida",
    "2": "Tapia pisada, adobe",
    "3": "Bahareque revocado",
    "4": "Bahareque sin revocar",
    "5": "Madera burda, tabla, tablón",
    "6": "Material prefabricado",
    "7": "Guadua, caña, esterilla, otro vegetal",
    "8": "Zinc, tela, carbón, latas, desechos, plástico",
    "9": "Sin paredes",
}

FLOOR_MATERIAL = {
    "1": "Alfombra o tapete de pared a pared",
    "2": "Madera pulida y lacada, parqué",
    "3": "Mármol",
    "4": "Baldosa, vinilo, tableta, ladrillo",
    "5": "Madera burda, tabla, tablón, otro vegetal",
    "6": "Cemento, gravilla",
    "7": "Tierra, arena",
}

ROOF_MATERIAL = {
    "1": "Plancha de concreto, cemento u hormigón",
    "2": "Tejas de barro",
    "3": "Teja de asbesto - cemento",
    "4": "Teja metálica o lámina de zinc",
    "5": "Teja plástica",
    "6": "Paja, palma u otros vegetales",
    "7": "Material de desecho (tela, cartón, latas, plástico, otros)",
}

URBAN_CLASS = {
    "1": "Cabecera (Urbano)",
    "2": "Centro poblado y rural disperso",
}

REGION = {
    "1": "Caribe",
    "2": "Oriental",
    "3": "Central",
    "4": "Pacífica (sin valle)",
    "5": "Bogotá",
    "6": "Antioquia",
    "7": "Valle del Cauca",
    "8": "San Andrés",
    "9": "Orinoquía-Amazonía",
}

SEX = {
    "1": "Hombre",
    "2": "Mujer",
}

CIVIL_STATUS = {
    "1": "No casado(a), vive en pareja menos de 2 años",
    "2": "No casado(a), vive en pareja 2 años o más",
    "3": "Viudo(a)",
    "4": "Separado(a) o divorciado(a)",
    "5": "Soltero(a)",
    "6": "Casado(a)",
}

ETHNICITY = {
    "1": "Indígena",
    "2": "Gitano (a) (Rom)",
    "3": "Raizal del archipiélago",
    "4": "Palenquero (a)",
    "5": "Negro (a), mulato (a) (afrodescendiente)",
    "6": "Ninguno de los anteriores",
}

BORN_ELSEWHERE = "2"
BORN_ABROAD = "3"

BIRTHPLACE = {
    "1": "En este municipio",
    "2": "En otro municipio colombiano",
    "3": "En otro país",
}

EDUCATION_LEVEL = {
    "1": "Ninguno",
    "2": "Preescolar",
    "3": "Básica primaria (1°–5°)",
    "4": "Básica secundaria (6°–9°)",
    "5": "Media (10°–13°)",
    "6": "Técnico sin título",
    "7": "Técnico con título",
    "8": "Tecnológico sin título",
    "9": "Tecnológico con título",
    "10": "Universitario sin título",
    "11": "Universitario con título",
    "12": "Postgrado sin título",
    "13": "Postgrado con título",
}

NOT_STUDYING_REASON = {
    "1": "Considera que no está en edad escolar",
    "2": "Considera que ya terminó",
    "3": "Falta de dinero o costos educativos elevados",
    "4": "Debe encargarse de los oficios del hogar",
    "5": "Por embarazo",
    "6": "Por inseguridad o malos tratos en el establecimiento educativo",
    "7": "Falta de cupos",
    "8": "No existe centro educativo cercano",
    "9": "Necesita trabajar",
    "10": "No le gusta o no le interesa el estudio",
    "11": "Por enfermedad",
    "12": "Necesita educación especial",
    "13": "Tuvieron que abandonar el lugar de residencia habitual",
    "14": "Sus padres o cuidador no lo considera importante",
    "15": "Por situaciones académicas (bajos resultados, repetición)",
    "16": "Otra razón",
}

SCHOOL_TYPE = {
    "1": "Oficial",
    "2": "No oficial",
}

SCHOOL_SHIFT = {
    "1": "Mañana",
    "2": "Tarde",
    "3": "Noche",
    "4": "Única o completa",
    "5": "Fin de semana",
}

SCHOLARSHIP_ENTITY = {
    "1": "De la misma institución educativa",
    "2": "Icetex",
    "3": "Gobierno nacional o departamental",
    "4": "Gobierno distrital o municipal",
    "5": "Otra entidad pública",
    "6": "Empresa pública donde trabaja un familiar",
    "7": "Empresa privada donde trabaja un familiar",
    "8": "Otra entidad privada",
}

AGE_BANDS = ((18, "0-17"), (30, "18-29"), (60, "30-59"))
OLDEST_BAND = "60+"
