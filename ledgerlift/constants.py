"""Values fixed by the target system."""

# Tender modalities as (number, name, short code, target code).
MODALITIES = [
    (1, "CONCURSO", "CS01", 7),
    (2, "MAT / SERV - CONVITE", "CC02", 2),
    (3, "MAT / SERV - TOMADA", "TOM3", 3),
    (4, "MAT / SERV - CONCORRENCIA", "CON4", 4),
    (5, "DISPENSA", "DI01", 1),
    (6, "INEXIGIBILIDADE", "IN01", 5),
    (7, "PREGÃO PRESENCIAL", "PP01", 8),
    (8, "PREGÃO ELETRÔNICO", "PE01", 9),
    (9, "DISPENSA", "DI01", 1),
    (10, "PREGÃO ELETRÔNICO", "PE01", 9),
    (11, "LEILÃO", "LEIL", 6),
    (12, "DISPENSA", "DI01", 1),
    (13, "DISPENSA", "DI01", 1),
    (14, "CONCORRÊNCIA ELETRÔNICA", "CE01", 13),
    (15, "DISPENSA ELETRÔNICA", "DE01", 11),
    (16, "DISPENSA", "DI01", 1),
    (17, "DISPENSA", "DI01", 1),
]
MODALITY_SCHEMA = "modality int, modality_name string, short_code string, modality_code int"

# Kinds of asset movement.
MOVEMENT_KINDS = [
    ("A", "Aquisição"),
    ("B", "Baixa"),
    ("T", "Transferência"),
    ("R", "Procedimento Contábil"),
    ("P", "Transferência de Plano Contábil"),
]
MOVEMENT_KIND_SCHEMA = "kind string, description string"

# The only adjustment kind and the only asset group.
ADJUSTMENT_KIND = (1, "REAVALIAÇÃO (ANTES DO CORTE)")
ASSET_GROUP = (1, "GERAL")

# Codes and labels written to target rows.
SERVICE_FAMILY = "9"
DEFAULT_LOT = "00000001"
LOT_LABEL = "Lote "
CLOSED_SCREEN = "I_ENCERRAMENTO"
UNIT_PRICE_CRITERION = "Menor Preco Unitario"
OTHER_PUBLICATION = "Outros"
DEFAULT_STORE = "000000001"
DEFAULT_CENTRE = "001"
VEHICLE_AUTHORITY = "02"
VEHICLE_BODY = "01"
OPENING_SERIAL = "000000"
OPENING_STORE = "000000000"
ACQUISITION = "AQUISICAO"
TRANSFER = "TRANSFERENCIA"
DEPRECIATION = "DEPRECIACAO "
REVALUATION = "REAVALIACAO"
WRITE_OFF = "BAIXA"
DISPOSAL_SALE = "ALIENACAO"

# Widths of the target's text columns; longer text is cut.
SUBJECT_WIDTH = 512
OFFICE_WIDTH = 100
BIDDER_WIDTH = 40
QUOTE_BIDDER_WIDTH = 70
UNIT_NAME_WIDTH = 60
DRIVER_WIDTH = 50
MODEL_WIDTH = 45

# Catalog groups (group number, group kind) and their item kind;
# every other group holds kind "P".
ITEM_KINDS = [
    (2000, "1", "E"),
    (1000, "3", "S"),
    (1000, "4", "S"),
    (2000, "4", "S"),
    (3000, "4", "S"),
]
