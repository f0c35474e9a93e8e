"""Fixed values the results depend on."""

# Risk score per rule, with the score of any other rule.
RISK_SCORES = {
    "high_amount": 0.85,
    "country_mismatch": 0.75,
    "velocity": 0.90,
    "device_change": 0.70,
}
DEFAULT_RISK_SCORE = 0.80

# Severity per rule, with the severity of any other rule.
SEVERITIES = {
    "high_amount": "high",
    "country_mismatch": "medium",
    "velocity": "high",
    "device_change": "low",
}
DEFAULT_SEVERITY = "medium"

# Source order status -> stored status.
ORDER_STATUS = {"paid": "delivered", "pending": "pending", "cancelled": "cancelled"}
DEFAULT_ORDER_STATUS = "pending"

# Source payment method -> stored method.
PAYMENT_METHOD = {
    "card": "credit_card",
    "paypal": "paypal",
    "bank_transfer": "bank_transfer",
}
DEFAULT_PAYMENT_METHOD = "credit_card"

# Fraud score on the 0-100 scale.
FRAUD_SCORE = 90.0
CLEAN_SCORE = 10.0

# Defaults of the curated tables.
DEFAULT_STOCK = 100
DEFAULT_STREET = "123 Rue de la Paix"
DEFAULT_CITY = "Paris"
DEFAULT_POSTCODE = "75001"
DEFAULT_ADDRESS_TYPE = "both"
PHONE_PREFIX = "+33612345"

# Accepted values of the checked columns.
ADDRESS_TYPES = ["billing", "shipping", "both"]
ORDER_STATUSES = ["pending", "paid", "cancelled", "processing", "shipped"]
PAYMENT_METHODS = ["card", "paypal", "bank_transfer"]
PAYMENT_RESULTS = ["success", "failed"]
DOCUMENT_TYPES = ["national_id", "passport", "driver_license"]
ALERT_SEVERITIES = ["low", "medium", "high", "critical"]
ALERT_STATUSES = ["open", "investigating", "resolved", "false_positive"]

# Event types and the topics they go to.
TOPICS = {
    "view": "user-events",
    "signup": "user-events",
    "click": "cart-events",
    "purchase": "orders",
    "error": "payments",
}

RULES = [
    "high_amount",
    "country_mismatch",
    "velocity",
    "device_change",
    "time_anomaly",
    "many_failed_attempts",
    "rapid_attempts",
]

# Texts of generated columns.
EMAIL_NAME = "customer"
FIRST_NAME, LAST_NAME = "FirstName", "LastName"
CONTACT_FIRST_NAME, CONTACT_LAST_NAME = "Client", "Test"
IP_PREFIX = "192.168."
BRAND_PREFIX = "Brand "
DESCRIPTION_PREFIX = "Description de "
ALERT_PREFIX = "Alerte déclenchée par règle: "
