"""Labels, amounts, thresholds and column lists that results depend on.

Everything in this module is a plain constant.  Each can be overridden by an
argument of the operator that uses it.
"""

# Class labels of the three-way attrition target.
GONE_NEXT = "BAJA+1"
GONE_IN_TWO = "BAJA+2"
STAYS = "CONTINUA"

# Row weights per class.
CLASS_WEIGHTS = {GONE_IN_TWO: 1.00002, GONE_NEXT: 1.00001}
OTHER_WEIGHT = 1.0

# Campaign amounts and decision settings.
GAIN_PER_HIT = 780_000
COST_PER_MISS = 20_000
DECISION_THRESHOLD = 0.025
CONTACTS = 11_500
PROBABILITY_MARGIN = 1e-15

# Sampling, folds, noise columns, model search.
UNDERSAMPLE_FACTOR = 6.0
UNDERSAMPLE_SEED = 509963
FOLDS = 5
FOLD_SEED = 12345
CANARIES = 20
SEARCH_TRIALS = 30
EARLY_STOP = 200
ROUNDS = 500

# Ranges of the parameter search, for the parameters that Spark's trees have.
SEARCH_SPACE = {
    "stepSize": ("log", 5e-4, 0.2),
    "maxDepth": ("int", 2, 16),
    "minInstancesPerNode": ("int", 5, 2000),
    "maxBins": ("int", 63, 511),
    "subsamplingRate": ("uniform", 0.5, 1.0),
    "featureSubsetStrategy": ("uniform", 0.4, 1.0),
    "minInfoGain": ("uniform", 0.0, 1.0),
}

# Drift and outlier report.
BASELINE_PERIODS = 19
PSI_BUCKETS = 10
PSI_EPSILON = 1e-8
PSI_LIMITS = (0.2, 0.3)
OUTLIER_LIMITS = (0.05, 0.10)
IQR_FACTOR = 3.0
FLAGGED_COLUMN_SHARE = 0.2

# Thresholds of the risk and behaviour flags.
NEAR_ZERO = 1e-12
INACTIVE_AT_MOST = 3
DROP_SHARE = 0.5
HIGH_UTILISATION = 0.80
LOW_TICKET = 2000
HIGH_FREQUENCY = 20
VETERAN_TENURE = 24
RECENT_TENURE = 6
MAXED_CREDIT = 0.95
LONG_INACTIVITY = 3

# Smoothing factors, window lengths and first period kept.
EMA_ALPHAS = (0.3, 0.6)
EXTREME_WINDOWS = (3, 6, 12)
FIRST_KEPT_PERIOD = 201907
DERIVED_MARKS = ("_ema_alpha", "_max_win", "_min_win")

# Columns dropped before training.
LEAK_COLUMNS = ("lag_3_ctrx_quarter", "mprestamos_personales", "cprestamos_personales")
CANARY_BLOCK_COLUMNS = (
    "mprestamos_personales",
    "cprestamos_personales",
    "Master_Finiciomora",
    "Visa_Finiciomora",
    "mes_idx",
    "foto_mes_int",
)

# Key and target columns of the bank panel.
BANK_KEY = {"id": "numero_de_cliente", "period": "foto_mes", "target": "clase_ternaria"}

# Source columns of the bank panel by role.
BANK_ROLES = {
    "spend_a": "Master_mconsumototal",
    "spend_b": "Visa_mconsumototal",
    "count_a": "Master_cconsumos",
    "count_b": "Visa_cconsumos",
    "limit_a": "Master_mlimitecompra",
    "limit_b": "Visa_mlimitecompra",
    "balance_a": "Master_msaldototal",
    "balance_b": "Visa_msaldototal",
    "sent_amount": "mtransferencias_emitidas",
    "received_amount": "mtransferencias_recibidas",
    "sent_count": "ctransferencias_emitidas",
    "cash_count": "ccajas_transacciones",
    "activity": "ctrx_quarter",
    "tenure": "cliente_antiguedad",
}

# Members of the thirteen group sums of the bank panel.
BANK_GROUPS = {
    "m_saldo_total_pesos": [
        "mcuenta_corriente", "mcaja_ahorro", "mcuenta_corriente_adicional",
        "mcaja_ahorro_adicional", "mcuentas_saldo",
    ],
    "m_saldo_total_dolares": ["mcaja_ahorro_dolares"],
    "m_consumo_tarjetas_pesos": ["mtarjeta_visa_consumo", "mtarjeta_master_consumo"],
    "m_consumo_tarjetas_dolares": ["Visa_mconsumosdolares", "Master_mconsumosdolares"],
    "m_pagos_recurrentes_pesos": [
        "mpagodeservicios", "mpagomiscuentas", "mcuenta_debitos_automaticos",
        "mttarjeta_visa_debitos_automaticos", "mttarjeta_master_debitos_automaticos",
    ],
    "m_inversiones_pesos": ["mplazo_fijo_pesos", "minversion1_pesos", "minversion2"],
    "m_inversiones_dolares": ["mplazo_fijo_dolares", "minversion1_dolares"],
    "m_endeudamiento_pesos": [
        "mprestamos_prendarios", "mprestamos_hipotecarios", "Master_msaldopesos",
        "Visa_msaldopesos", "Master_madelantopesos", "Visa_madelantopesos",
    ],
    "m_endeudamiento_dolares": [
        "Master_msaldodolares", "Visa_msaldodolares",
        "Master_madelantodolares", "Visa_madelantodolares",
    ],
    "m_payroll_total": ["mpayroll", "mpayroll2"],
    "m_limite_compra_total": ["Master_mlimitecompra", "Visa_mlimitecompra"],
    "c_seguros_total": [
        "cseguro_vida", "cseguro_auto", "cseguro_vivienda", "cseguro_accidentes_personales",
    ],
    "c_transacciones_total": [
        "ctarjeta_debito_transacciones", "ctarjeta_visa_transacciones",
        "ctarjeta_master_transacciones", "chomebanking_transacciones", "cmobile_app_trx",
        "ccallcenter_transacciones", "catm_trx", "catm_trx_other", "ccajas_transacciones",
    ],
}

# Group sums that get no smoothing and no extremes.
BANK_GROUPS_NOT_SMOOTHED = ("c_seguros_total",)
