"""Preset for a monthly mortgage performance panel (110 positional fields)."""

from __future__ import annotations

from panelwright.spec import CleanRules, Last, PanelSpec, RiskRules, parse_layout

# Positional record layout, one "name kind" per line, in file order.
LAYOUT = """
reference_pool_id unused
loan_id text
monthly_reporting_period date
channel text
seller_name text
servicer_name text
master_servicer unused
orig_interest_rate float
current_interest_rate float
orig_upb float
upb_at_issuance unused
current_actual_upb float
orig_loan_term int
origination_date date
first_payment_date date
loan_age int
remaining_months_legal_maturity int
remaining_months_to_maturity int
maturity_date date
orig_ltv int
orig_cltv int
num_borrowers int
dti int
borrower_credit_score int
co_borrower_credit_score int
first_time_buyer text
loan_purpose text
property_type text
num_units int
occupancy_status text
property_state text
msa text
zip_code_short text
mi_percentage float
amortization_type text
prepayment_penalty_indicator text
interest_only_indicator text
io_first_pi_payment_date date
months_to_amortization int
current_delinquency_status int
loan_payment_history text
modification_flag text
mi_cancellation_indicator unused
zero_balance_code text
zero_balance_effective_date date
upb_at_time_of_removal float
repurchase_date unused
scheduled_principal_current unused
total_principal_current float
unscheduled_principal_current unused
last_paid_installment_date date
foreclosure_date date
disposition_date date
foreclosure_costs float
property_preservation_repair_costs float
asset_recovery_costs float
misc_holding_expenses_credits float
associated_taxes_holding_property float
net_sales_proceeds float
credit_enhancement_proceeds float
repurchase_make_whole_proceeds float
other_foreclosure_proceeds float
modification_related_ni_upb float
principal_forgiveness_amount float
original_list_start_date unused
original_list_price unused
current_list_start_date unused
current_list_price unused
borrower_credit_score_at_issuance unused
co_borrower_credit_score_at_issuance unused
borrower_credit_score_current unused
co_borrower_credit_score_current unused
mi_type text
servicing_activity_indicator text
current_period_modification_loss unused
cumulative_modification_loss unused
current_period_credit_event_net_gain_loss unused
cumulative_credit_event_net_gain_loss unused
special_eligibility_program text
foreclosure_principal_writeoff float
relocation_mortgage_indicator text
zero_balance_code_change_date unused
loan_holdback_indicator unused
loan_holdback_effective_date unused
delinquent_accrued_interest unused
property_valuation_method text
high_balance_loan_indicator text
arm_initial_fixed_rate_5yr_indicator unused
arm_product_type unused
initial_fixed_rate_period unused
interest_rate_adjustment_frequency unused
next_interest_rate_adjustment_date unused
next_payment_change_date unused
index_description unused
arm_cap_structure unused
initial_interest_rate_cap_up_pct unused
periodic_interest_rate_cap_up_pct unused
lifetime_interest_rate_cap_up_pct unused
mortgage_margin unused
arm_balloon_indicator unused
arm_plan_number unused
borrower_assistance_plan text
hltv_refi_option_indicator text
deal_name unused
repurchase_make_whole_proceeds_flag text
alternative_delinquency_resolution text
alternative_delinquency_resolution_count int
total_deferral_amount float
payment_deferral_mod_event_indicator text
interest_bearing_upb unused
"""

QUARTER = "acquisition_quarter"

# Codes that mean "unknown", and inclusive plausible ranges.
SENTINELS = {
    "orig_ltv": ("999",),
    "orig_cltv": ("999",),
    "num_borrowers": ("99",),
    "dti": ("999",),
    "borrower_credit_score": ("9999",),
    "co_borrower_credit_score": ("9999",),
    "mi_percentage": ("999",),
    "current_delinquency_status": ("XX",),
}
BOUNDS = {
    "orig_interest_rate": (0, 20),
    "current_interest_rate": (0, 20),
    "orig_loan_term": (1, 480),
    "loan_age": (-5, 600),
    "orig_ltv": (1, 200),
    "orig_cltv": (1, 200),
    "num_borrowers": (1, 10),
    "dti": (0, 65),
    "borrower_credit_score": (300, 850),
    "co_borrower_credit_score": (300, 850),
    "num_units": (1, 4),
    "mi_percentage": (0, 60),
    "current_delinquency_status": (0, 99),
}
# Narrower ranges used by the raw-data range audit.
AUDIT_BOUNDS = {
    "borrower_credit_score": (300, 850),
    "co_borrower_credit_score": (300, 850),
    "dti": (0, 65),
    "orig_ltv": (1, 200),
    "orig_cltv": (1, 200),
    "orig_interest_rate": (0.001, 15),
    "current_interest_rate": (0.001, 15),
    "num_borrowers": (1, 10),
    "num_units": (1, 4),
    "orig_loan_term": (1, 480),
    "loan_age": (-1, 600),
    "mi_percentage": (0, 60),
}

CLEAN = CleanRules(
    layout=parse_layout(LAYOUT),
    extra_text=(QUARTER,),
    sentinels=SENTINELS,
    recodes={"borrower_assistance_plan": {"Y": "F"}},
    bounds=BOUNDS,
)

# Cost and proceeds columns in which a missing value means zero.
COSTS = (
    "foreclosure_costs",
    "property_preservation_repair_costs",
    "asset_recovery_costs",
    "misc_holding_expenses_credits",
    "associated_taxes_holding_property",
)
PROCEEDS = (
    "net_sales_proceeds",
    "credit_enhancement_proceeds",
    "repurchase_make_whole_proceeds",
    "other_foreclosure_proceeds",
)
DEFAULT_CODES = ("02", "03", "09", "15")
CREDIT_EVENT_CODES = ("02", "03", "09", "15", "16")

PANEL = PanelSpec(
    entity="loan_id",
    period="monthly_reporting_period",
    age="loan_age",
    status="current_delinquency_status",
    transfer="servicing_activity_indicator",
    plan="borrower_assistance_plan",
    modified="modification_flag",
    code="zero_balance_code",
    # Attributes taken once per loan.
    static=(
        "acquisition_quarter",
        "channel",
        "orig_interest_rate",
        "orig_upb",
        "orig_loan_term",
        "origination_date",
        "orig_ltv",
        "orig_cltv",
        "num_borrowers",
        "dti",
        "borrower_credit_score",
        "co_borrower_credit_score",
        "first_time_buyer",
        "loan_purpose",
        "property_type",
        "num_units",
        "occupancy_status",
        "property_state",
        "mi_percentage",
        "mi_type",
        "high_balance_loan_indicator",
    ),
    last=(
        Last("zero_balance_code", "final_zero_balance_code"),
        Last("disposition_date", "final_disposition_date"),
        Last("foreclosure_date", "final_foreclosure_date"),
        Last("current_interest_rate", "last_interest_rate"),
        Last("current_actual_upb", "last_active_upb", positive=True),
        Last("loan_payment_history", "last_loan_payment_history"),
        Last("upb_at_time_of_removal", "final_upb_at_removal"),
        *(Last(c, c) for c in COSTS + PROCEEDS),
    ),
    active_plans=("F", "R", "T", "O"),
    default_codes=DEFAULT_CODES,
)

RISK = RiskRules(
    default_codes=DEFAULT_CODES,
    clean_codes=("01", "06"),
    # Inclusive origination years per era.
    vintages={
        "Pre-crisis": (2000, 2008),
        "Recovery": (2009, 2013),
        "Stable": (2014, 2019),
        "COVID-era": (2020, 2025),
    },
    costs=COSTS,
    proceeds=PROCEEDS,
)

# Sample sizes wanted per risk stratum.
TARGETS_A = {"performing": 25000, "early_dlq": 10000, "serious_dlq": 10000, "default": 5000}
TARGETS_B = {"performing": 250000, "early_dlq": 100000, "serious_dlq": 100000, "default": 50000}
SEED_A, SEED_B = 42, 123

# Ordered column contracts of the two samples.
SUBSET_A = (
    "loan_id acquisition_quarter stratum origination_year property_state "
    "borrower_credit_score dti num_borrowers first_time_buyer has_coborrower "
    "orig_interest_rate orig_upb orig_loan_term orig_ltv orig_cltv mi_percentage "
    "high_balance_loan_indicator max_delinquency_status months_delinquent_30plus "
    "months_delinquent_90plus ever_modified had_forbearance loan_duration_months "
    "time_to_first_delinquency ph_months_delinquent_24 ph_max_delinquency_24 "
    "channel loan_purpose property_type occupancy_status vintage_bin lph_available "
    "is_default net_loss net_severity ever_d90 ever_d180 ever_foreclosed "
    "final_zero_balance_code is_clean_liquidation time_to_default"
).split()
SUBSET_B = SUBSET_A + (
    "co_borrower_credit_score mi_type num_units months_delinquent_60plus "
    "had_servicing_transfer ph_months_current_24 ph_recent_delinquency_3m "
    "rate_spread upb_paydown_pct last_active_upb"
).split()

# Meaning of the categorical codes.
LABELS = {
    "channel": {"R": "Retail", "C": "Correspondent", "B": "Broker"},
    "loan_purpose": {"P": "Purchase", "R": "Refinance", "C": "Cash-out refinance", "U": "Unspecified"},
    "property_type": {
        "SF": "Single-family",
        "PU": "Planned unit development",
        "CO": "Condominium",
        "MH": "Manufactured housing",
        "CP": "Cooperative",
    },
    "occupancy_status": {"P": "Principal", "S": "Second home", "I": "Investment", "U": "Unknown"},
    "first_time_buyer": {"Y": "Yes", "N": "No"},
    "zero_balance_code": {
        "01": "Prepaid or matured",
        "02": "Third-party sale (default)",
        "03": "Short sale (default)",
        "06": "Repurchased",
        "09": "REO disposition (default)",
        "15": "Non-performing sale (default)",
        "16": "Re-performing sale",
        "96": "Removal",
    },
    "current_delinquency_status": {
        "00": "Current",
        "01": "30-59 days",
        "02": "60-89 days",
        "03": "90-119 days",
        "XX": "Unknown",
    },
}

# Ordered levels for ordinal encoding.
LEVELS = {
    "channel": ("R", "B", "C", "T", "W", "N", "O"),
    "loan_purpose": ("P", "C", "N", "R", "U"),
    "property_type": ("SF", "CO", "MH", "PU", "CP", "LH", "UT"),
    "occupancy_status": ("P", "S", "I", "U"),
    "vintage_bin": tuple(RISK.vintages),
}

# Feature groups of the embedding input.
CONTINUOUS = (
    "orig_interest_rate upb_paydown_pct orig_upb dti max_delinquency_status mi_percentage "
    "borrower_credit_score co_borrower_credit_score orig_ltv orig_cltv orig_loan_term "
    "months_delinquent_30plus months_delinquent_60plus months_delinquent_90plus "
    "loan_duration_months time_to_first_delinquency ph_months_current_24 "
    "ph_months_delinquent_24 ph_max_delinquency_24 rate_spread last_active_upb"
).split()
CATEGORICAL = (
    "channel loan_purpose property_type occupancy_status vintage_bin mi_type num_units"
).split()
BINARY = (
    "first_time_buyer has_coborrower high_balance_loan_indicator ever_modified "
    "had_forbearance had_servicing_transfer lph_available ph_recent_delinquency_3m"
).split()
HISTORY_FEATURES = (
    "ph_months_current_24 ph_months_delinquent_24 ph_max_delinquency_24 ph_recent_delinquency_3m"
).split()

# Variable blocks of the factor analysis and the composite index.
ORIGINATION_BLOCK = (
    "borrower_credit_score dti orig_ltv orig_cltv mi_percentage orig_interest_rate orig_upb "
    "orig_loan_term num_borrowers first_time_buyer has_coborrower occupancy_ord "
    "loan_purpose_ord property_type_ord channel_ord high_balance_loan_indicator"
).split()
# The block's columns by the factor they belong to.
ORIGINATION_FACTORS = {
    "orig_F_crediticia": "borrower_credit_score dti num_borrowers first_time_buyer has_coborrower".split(),
    "orig_F_apalancamiento": "orig_ltv orig_cltv mi_percentage".split(),
    "orig_F_exposicion": "orig_upb orig_interest_rate high_balance_loan_indicator".split(),
    "orig_F_contractual": "orig_loan_term loan_purpose_ord channel_ord property_type_ord occupancy_ord".split(),
}
BEHAVIOUR_BLOCK = (
    "months_delinquent_30plus months_delinquent_90plus max_delinquency_status ph_max_delinquency_24"
).split()
CONTEXT_BLOCK = "orig_year_std vintage_ord acq_q_num".split()
SMD_COLUMNS = "borrower_credit_score orig_ltv dti orig_upb".split()
OUTCOMES = "ever_d90 ever_d180 ever_foreclosed is_default had_forbearance ever_modified".split()
PROFILE_COLUMNS = (
    "borrower_credit_score dti orig_ltv orig_interest_rate orig_upb orig_loan_term mi_percentage "
    "max_delinquency_status months_delinquent_30plus months_delinquent_90plus "
    "loan_duration_months time_to_first_delinquency ph_months_delinquent_24 is_default "
    "ever_d90 ever_d180 ever_foreclosed had_forbearance ever_modified net_severity"
).split()
# Columns checked for one value per loan.
STATIC_AUDIT = (
    "channel orig_interest_rate orig_upb orig_loan_term origination_date first_payment_date "
    "orig_ltv orig_cltv dti borrower_credit_score co_borrower_credit_score first_time_buyer "
    "loan_purpose property_type num_units occupancy_status property_state amortization_type"
).split()
