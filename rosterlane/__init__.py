"""rosterlane: outreach-campaign reporting as DataFrame operators and two end products."""
