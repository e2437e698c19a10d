"""slotflow: warehouse replenishment and tote moves on PySpark."""
