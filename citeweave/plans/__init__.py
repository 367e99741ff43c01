"""The four stages as whole plans: acquire, integrate, features, describe."""
