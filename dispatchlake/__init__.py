"""Analytics for contact-centre and incident data on Spark."""
