"""Record layouts of the disclosure files.

Fixed values: the field names and their order must equal the published file
layouts for the positional split to land on the right columns.
"""

from __future__ import annotations

# Single-family loan record, prefix 'LL', 55 fields.
LL_FIELDS = [
    "record_type", "cusip_number", "pool_id", "pool_indicator", "pool_type", "pool_issue_date",
    "disclosure_sequence_number", "issuer_id", "agency", "loan_purpose", "refinance_type",
    "first_payment_date", "maturity_date", "loan_interest_rate", "original_principal_balance",
    "upb_at_issuance", "unpaid_principal_balance", "original_loan_term", "loan_age",
    "remaining_loan_term", "months_delinquent", "months_pre_paid", "loan_gross_margin",
    "loan_to_value", "combined_ltv", "total_debt_expense_ratio", "credit_score",
    "down_payment_assistance", "buy_down_status", "upfront_mip", "annual_mip",
    "number_of_borrowers", "first_time_home_buyer", "property_type", "state_code", "msa",
    "third_party_origination_type", "current_month_liquidation_flag", "removal_reason",
    "as_of_date", "loan_origination_date", "seller_issuer_id", "index_type", "look_back_period",
    "interest_rate_change_date", "initial_interest_rate_cap", "subsequent_interest_rate_cap",
    "lifetime_interest_rate_cap", "next_interest_rate_change_ceiling",
    "lifetime_interest_rate_ceiling", "lifetime_interest_rate_floor", "prospective_interest_rate",
    "arm_adjustment_effective_date", "scheduled_unpaid_principal_balance",
    "re_performing_loan_indicator",
]

# The 16 kept for the tables of loan-months and of static loans.
LL_KEPT = [
    "disclosure_sequence_number", "issuer_id", "agency", "loan_interest_rate", "original_principal_balance",
    "unpaid_principal_balance", "loan_age", "months_delinquent", "loan_to_value", "credit_score",
    "down_payment_assistance", "first_time_home_buyer", "state_code", "msa", "loan_origination_date", "seller_issuer_id",
]

# Liquidation record, prefix 'LR', 15 fields, and the 10 kept for the liquidation table.
LR_FIELDS = [
    "record_type", "cusip_number", "pool_id", "pool_indicator", "pool_type", "pool_issue_date",
    "disclosure_sequence_number", "issuer_id", "report_period", "agency_type", "loan_purpose",
    "original_principal_balance", "unpaid_principal_balance", "liquidation_balance", "removal_reason",
]
LR_KEPT = [
    "disclosure_sequence_number", "issuer_id", "cusip_number", "pool_id", "agency_type",
    "loan_purpose", "original_principal_balance", "unpaid_principal_balance", "liquidation_balance",
    "removal_reason",
]

# Multifamily pool/loan record, prefix 'M', 76 fields.
M_FIELDS = [
    "record_type_indicator",
    "cusip_number", "pool_number", "pool_indicator", "pool_type", "security_interest_rate",
    "pool_issue_date", "pool_maturity_date", "original_aggregate_amount", "issuer_number",
    "issuer_name", "issuer_address_1", "issuer_address_2", "issuer_city", "issuer_state",
    "issuer_zip_code_1", "issuer_zip_code_2", "pool_upb", "number_of_loans_in_pool",
    "number_of_loans_30_days_delinquent", "upb_of_loans_30_days_delinquent",
    "percentage_upb_of_loans_30_days_delinquent", "number_of_loans_60_days_delinquent",
    "upb_of_loans_60_days_delinquent", "percentage_upb_of_loans_60_days_delinquent",
    "number_of_loans_90_plus_days_delinquent", "upb_of_loans_90_plus_days_delinquent",
    "percentage_upb_of_loans_90_plus_days_delinquent", "security_rpb", "rpb_factor",
    "project_loan_security_interest_rate", "estimated_mortgage_amount",
    "disclosure_sequence_number", "case_number", "agency_type", "loan_type", "loan_term",
    "first_payment_date", "maturity_date_of_loan", "loan_interest_rate", "modified_loan_indicator",
    "non_level_payments_indicator", "mature_loan_certification_flag", "loan_origination_date",
    "initial_endorsement_date", "final_endorsement_date", "lockout_term", "lockout_period_end_date",
    "prepayment_premium_period", "prepayment_end_date", "interest_approval_date",
    "pre_payment_penalty_flag", "original_principal_balance", "upb_at_issuance",
    "unpaid_principal_balance", "draw_number", "approved_draw_amount", "months_delinquent",
    "current_month_liquidation_flag", "removal_reason", "seller_issuer_id", "property_name",
    "property_street", "property_city", "property_state", "property_zip", "msa", "number_of_units",
    "current_principal_and_interest_amount", "prepayment_description",
    "description_of_non_level_adjustment_period", "fha_program_section_code", "insurance_type",
    "as_of_date", "green_status", "affordable_status",
]
# Issuer part and loan part of an M record (0-based positions).
M_ISSUER_POSITIONS = list(range(9, 17))

# Non-level payment record, prefix 'N', 10 fields.
N_FIELDS = [
    "record_type", "cusip", "pool_number", "pool_indicator", "pool_type", "disclosure_seq_number",
    "effective_date", "security_interest_rate", "mortgage_interest_rate", "principal_and_interest",
]

# Second agency's loan performance file: the first 50 pipe-separated columns.
FNMA_FIELDS = [
    "reference_pool_id", "loan_identifier", "monthly_reporting_period", "channel", "seller_name",
    "servicer_name", "master_servicer", "original_interest_rate", "current_interest_rate", "original_upb",
    "upb_at_issuance", "current_actual_upb", "original_loan_term", "origination_date", "first_payment_date",
    "loan_age", "remaining_months_to_legal_maturity", "remaining_months_to_maturity", "maturity_date",
    "original_ltv", "original_cltv", "number_of_borrowers", "dti", "borrower_credit_score_at_origination",
    "co_borrower_credit_score_at_origination", "first_time_home_buyer_indicator", "loan_purpose",
    "property_type", "number_of_units", "occupancy_status", "property_state", "msa", "zip_code_short",
    "mortgage_insurance_percentage", "amortization_type", "prepayment_penalty_indicator",
    "interest_only_loan_indicator", "interest_only_first_principal_and_interest_payment_date",
    "months_to_amortization", "current_loan_delinquency_status", "loan_payment_history", "modification_flag",
    "mortgage_insurance_cancellation_indicator", "zero_balance_code", "zero_balance_effective_date",
    "upb_at_the_time_of_removal", "repurchase_date", "scheduled_principal_current", "total_principal_current",
    "unscheduled_principal_current",
]
FNMA_STATIC_FIELDS = [
    "loan_identifier", "reference_pool_id", "seller_name", "loan_purpose", "origination_date", "original_upb",
    "borrower_credit_score_at_origination", "original_ltv", "property_state", "msa", "property_type",
    "number_of_units", "occupancy_status", "number_of_borrowers", "first_time_home_buyer_indicator", "dti",
]

