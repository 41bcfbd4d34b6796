"""Tables on shared storage, generators and roots."""
